"""Dense numbers along a total order, without one task that sees every row.

The rows are dealt into ranges of the order (Spark samples the bounds), sorted within each range
and stored with their place in it.  Counting the stored rows per range and adding up the counts
of the ranges before gives each range its first number.  What reaches the driver is one count
per range; the numbers go back into the plan as one literal, so nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.session import work_dir

#: ``monotonically_increasing_id`` has the task in its upper bits and the place in the task in the lower 33.
PLACE_BITS = 33


def dealt(df: DataFrame, order: Sequence[str | Column], ranges: int) -> DataFrame:
    """The rows in ranges of the order, one after the other and sorted within."""
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def numbered(
    df: DataFrame, order: Sequence[str | Column], out: str = "seq", start: int = 0, ranges: int | None = None
) -> DataFrame:
    """Add ``out``: each row's number in the order given, from ``start`` and without gaps.

    Rows that are equal in ``order`` get different numbers in no fixed sequence, so name columns
    that tell all rows apart where the numbers must be the same on every run.  Nulls come first.
    ``ranges`` is the number of parts (``spark.sql.shuffle.partitions`` unless given).  The rows
    are stored in the shared folder, which also fixes their numbers: a task that is run again
    reads what was stored.  An empty table stays empty.  Rows equal in ``order`` are
    never split between ranges, so the last columns of ``order`` should tell frequent values apart.
    """
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, "numbered")
    dealt(df, order, count).withColumn(out, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(df.select("*", F.lit(0).cast("bigint").alias(out)).schema).parquet(path)

    part, place = F.shiftright(out, PLACE_BITS), F.col(out).bitwiseAND((1 << PLACE_BITS) - 1)
    rows = dict(stored.groupBy(part).count().collect())
    before = accumulate((rows.get(i, 0) for i in range(max(rows, default=0))), initial=start)
    firsts = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    return stored.withColumn(out, F.get(firsts, part.cast("int")) + place)
