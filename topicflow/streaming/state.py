"""Read what a stateful job has stored, from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.streaming.jobs import Job


def stored_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The raw state table: key and value structs with the partition that hosts them."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def _in_reverse(rows: DataFrame, key: str, overall: bool) -> DataFrame:
    return rows.orderBy(F.desc(key)) if overall else rows.sortWithinPartitions(F.desc(key))


def stored_counts(
    spark: SparkSession, job: Job, key: str = "word", batch_id: int | None = None, overall: bool = False
) -> DataFrame:
    """Stored count per key, keys in reverse order within each store or, with a shuffle, ``overall``."""
    state = stored_state(spark, job.folders.checkpoint, batch_id)
    rows = state.select(F.col("key")[key].alias(key), F.col("value.count").alias("n"), "partition_id")
    return _in_reverse(rows, key, overall)


def stored_balances(
    spark: SparkSession, job: Job, key: str = "key", batch_id: int | None = None, overall: bool = False
) -> DataFrame:
    """Stored account record per key, keys in reverse order within each store or, with a shuffle, ``overall``.

    The store holds the aggregate's buffer: the id that arrived last, then the newest event.
    """
    state = stored_state(spark, job.folders.checkpoint, batch_id)
    newest = F.col("value.max")
    rows = state.select(
        F.col("key")[key].alias(key),
        F.col("value.valueWithExtremumOrdering").alias("id"),
        F.coalesce(newest["amount"], F.lit(0.0)).alias("amount"),
        F.coalesce(newest["timestamp"], F.lit(0).cast("bigint")).alias("timestamp"),
        "partition_id",
    )
    return _in_reverse(rows, key, overall)


def state_changes(spark: SparkSession, checkpoint: str, first: int, last: int) -> DataFrame:
    """What micro-batches ``first`` to ``last`` have put into a job's store and taken out of it.

    One row per key and batch that changed it: (batch_id, change_type, key, value, partition_id).  It is read from the
    store's own change files (``use_rocksdb`` has them written), as far back as the checkpoint keeps them.
    """
    reader = spark.read.format("statestore").option("readChangeFeed", True)
    return reader.option("changeStartBatchId", first).option("changeEndBatchId", last).load(checkpoint)


def count_changes(spark: SparkSession, job: Job, first: int, last: int, key: str = "word") -> DataFrame:
    """Counts as each micro-batch has left them, for the keys it changed: (batch_id, change_type, key, n, partition_id)."""
    return state_changes(spark, job.folders.checkpoint, first, last).select(
        "batch_id", "change_type", F.col("key")[key].alias(key), F.col("value.count").alias("n"), "partition_id"
    )


def changes_per_store(changes: DataFrame) -> DataFrame:
    """How many keys each micro-batch has changed in each store, by kind of change."""
    return changes.groupBy("batch_id", "partition_id", "change_type").agg(F.count(F.lit(1)).alias("keys"))


def stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state stores of a job: operator, number of partitions, first and last batch kept."""
    return spark.read.format("state-metadata").load(checkpoint)
