"""Each record once, over a topic that may hold it several times.

A sink that delivers at least once writes a batch again when it is run again.  A producer therefore marks its
records with its name and with numbers that grow within each (producer, partition) and are the same when the
batch is run again.  The reader remembers the highest number of each producer and partition, and nothing
else: a record that is not above it has been seen.  So the state is as large as the number of producers and
partitions, not as the number of records.

This needs a partition to keep the order in which a producer writes to it, as a log does: what is met of a batch
that failed half-way is then its beginning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicflow.streaming.jobs import Folders, Job, folders, start_batches
from topicflow.streaming.store import KeyedTable

PRODUCER, BATCH = "producer", "producer_batch"
KEYS = (PRODUCER, "partition")
SEEN = "producer string, partition int, state struct<batch: bigint, number: bigint>"


def marked(rows: DataFrame, producer: str, batch_id: int) -> DataFrame:
    """Records with what tells a reader whether it has seen them; ``seq`` tells the records of a batch apart."""
    return rows.withColumns({PRODUCER: F.lit(producer), BATCH: F.lit(batch_id).cast("bigint")})


def _number(seq: str) -> Column:
    return F.struct(F.col(BATCH).alias("batch"), F.col(seq).cast("bigint").alias("number"))


def once(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Each record of a bounded topic table once, marks taken off."""
    return rows.dropDuplicates([*KEYS, BATCH, seq]).drop(PRODUCER, BATCH)


def _seen(spark: SparkSession, at: Folders) -> KeyedTable:
    return KeyedTable(spark, at.table("seen"), SEEN, KEYS, F.max, buckets=1)


def start_once(rows: DataFrame, root: str, seq: str = "seq", fresh: bool = False, **trigger) -> Job:
    """Follow a topic and write each of its records once, marks taken off."""
    at = folders(root, fresh)

    def advance(batch: DataFrame, batch_id: int) -> DataFrame:
        number = _number(seq)
        highest = batch.groupBy(*KEYS).agg(F.max(number).alias("state"))
        before = _seen(batch.sparkSession, at).take(highest, batch_id)
        if before is not None:
            # one row per producer and partition, so Spark broadcasts it by its size
            batch = batch.join(before.withColumnRenamed("state", "_seen"), list(KEYS), "left")
            batch = batch.where(F.col("_seen").isNull() | (number > F.col("_seen")))
        return once(batch.select(*rows.columns), seq)

    return start_batches(rows, at, advance, rows.drop(PRODUCER, BATCH).schema, **trigger)


def seen(spark: SparkSession, job: Job) -> DataFrame:
    """The highest number met of each producer and partition."""
    return _seen(spark, job.folders).read().select(*KEYS, "state.*")
