"""Exact duplicates by sorting contents.

Texts are equal when they are the same bytes after each run of white space has become one
space.  The normalised texts are sorted as a whole: sampled splitters cut the order into
buckets of like many bytes, each bucket is sorted by itself (Spark's sort spills to disk), and
a row is a copy if the full text of the row before it is the same.

The order is (beginning of the text, hash of all of it, the text, the id).  Splitters name
the first two and a hash of the id, so each is a short string however long the texts are,
and a text with very many copies is cut between its copies: its buckets are as large as any
others.  A text is met in two buckets only if a splitter names its beginning and hash; those
few runs, at most two a bucket unless hashes collide, are then compared by their texts again
and joined.

Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.llm.common import written
from topicflow.operators.ordering import numbered

#: White space that counts, as in the words of the other operators.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of the beginning of a text that a splitter holds.
HEAD = 32
#: Hex digits of a beginning and of the hash of a text.
NAMED = 2 * HEAD + 16
#: Most bytes of texts in a bucket, and what a row counts for besides its text.
BUCKET_BYTES = 128 << 20
ROW_BYTES = 100
#: Sampled points for each splitter.
POINTS = 32


def normalised(text: str | Column) -> Column:
    """Runs of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _hex(hash: Column) -> Column:
    return F.lpad(F.hex(hash), 16, "0")


def _named(norm: Column) -> Column:
    """What comes first in the order: the beginning of a text, then its hash."""
    head = F.rpad(F.hex(F.substring(norm.cast("binary"), 1, HEAD)), 2 * HEAD, "0")
    return F.concat(head, _hex(F.xxhash64(norm)))


def _tie(id: Column) -> Column:
    """Where a copy stands among the copies of its text; copies without an id are told apart by the task that reads them."""
    return _hex(F.xxhash64(id, F.when(id.isNull(), F.spark_partition_id())))


def _splitters(rows: DataFrame, bucket_bytes: int) -> list[str]:
    """Keys that cut the rows (id, text) into buckets of like many bytes, in order.

    Every ``bucket_bytes / POINTS`` bytes of text give one sampled point: a long text several,
    a short one with a probability.  Every ``POINTS``-th point is a splitter.
    """
    spark = rows.sparkSession
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES
    total = rows.agg(F.sum(weight.cast("bigint"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, min(bucket_bytes, total // least) // POINTS)
    times = F.floor(weight / F.lit(step) + F.rand(42)).cast("int")
    points = rows.select("id", "text", times.alias("times")).where("times > 0")
    key = F.concat(_named(normalised("text")), _tie(F.col("id")))
    points = points.select(key.alias("key"), F.explode(F.sequence(F.lit(1), "times")).alias("nth"))
    placed = numbered(points, ["key", "nth"], "at")
    cuts = placed.where((F.col("at") % POINTS == 0) & (F.col("at") > 0)).select("key").distinct()
    return sorted(r["key"] for r in cuts.collect())


def _bucket(key: Column, splitters: Column, count: int) -> Column:
    """How many of the splitters are not above the key, by halving."""
    halves = [1 << i for i in reversed(range(count.bit_length()))]

    def step(low: Column, half: Column) -> Column:
        to = low + half
        return F.when((to <= count) & (F.get(splitters, to - 1) <= key), to).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step) if halves else F.lit(0)


def exact_duplicates(
    df: DataFrame, text: str = "text", id: str = "doc_id", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of ``df``.

    ``keep_id`` is the smallest id among the rows whose normalised texts are equal, and ``kept``
    marks its row.  A null text counts as empty.  A row without an id stays only if none of its
    copies has one (``keep_id`` is null then); of rows that repeat text and id, one
    stays.  ``group_size`` counts rows.  An empty table gives no rows; other columns do
    not matter.  ``text_sha256`` is that of the normalised text in UTF-8.
    """
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = _splitters(rows, bucket_bytes)
    splitters, count = F.split(F.lit(",".join(found)), ","), len(found)

    rows = rows.select("id", normalised("text").alias("norm"))
    rows = rows.select("id", "norm", _named(F.col("norm")).alias("named"))
    rows = rows.withColumn("bucket", _bucket(F.concat("named", _tie(F.col("id"))), splitters, count))
    # a splitter that names this text may have cut it
    edges = [F.get(splitters, F.col("bucket") - 1), F.get(splitters, F.col("bucket"))]
    cut = reduce(Column.__or__, [F.coalesce(F.left(e, F.lit(NAMED)) == F.col("named"), F.lit(False)) for e in edges])

    sorted_rows = Window.partitionBy("bucket").orderBy("named", "norm", F.asc_nulls_last("id"))
    rows = rows.repartitionById(count + 1, "bucket").select(
        "bucket",
        "id",
        "norm",
        "named",
        F.row_number().over(sorted_rows).alias("at"),
        F.lag("norm").over(sorted_rows).eqNullSafe(F.col("norm")).alias("again"),
    )
    rows = rows.select(
        "bucket",
        "id",
        "at",
        (~F.col("again")).alias("first"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.when(~F.col("again") & cut, F.col("norm")).alias("cut"),
    )
    rows = rows.withColumn("run", F.sum(F.col("first").cast("int")).over(Window.partitionBy("bucket").orderBy("at")))
    run = Window.partitionBy("bucket", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"least": F.first("id").over(run), "size": F.count(F.lit(1)).over(run)})
    rows = written(rows.drop("at"), "runs")

    cuts = rows.where("cut IS NOT NULL").select("bucket", "run", "cut", "least", "size")
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "bucket", "run"))
    whole = cuts.groupBy("cut").agg(first.alias("first"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("runs"))
    joined = cuts.select("bucket", "run", "cut").join(whole.where("runs > 1"), "cut")
    joined = joined.select(
        "bucket",
        "run",
        F.col("first.least").alias("whole_least"),
        F.col("size").alias("whole_size"),
        ((F.col("first.bucket") == F.col("bucket")) & (F.col("first.run") == F.col("run"))).alias("leads"),
    )
    parts = written(joined, "joined")
    of = F.col("whole_size").isNotNull()
    return rows.join(parts, ["bucket", "run"], "left").select(
        F.col("id").alias("doc_id"),
        F.when(of, F.col("whole_least")).otherwise(F.col("least")).alias("keep_id"),
        F.coalesce("whole_size", "size").alias("group_size"),
        (F.col("first") & F.coalesce("leads", F.lit(True))).alias("kept"),
        "text_sha256",
    )
