"""Per-record changelogs of keyed tables, live.

A built-in streaming aggregate gives one row per key and micro-batch; these jobs give
one row per record.  Each micro-batch runs the batch operator on its records, starting
from the state the batches before it have left.  So a live changelog has the batch
plan's properties: built-in columns only, and no key's records in one task.

The state is a keyed table in the job's folder (``store.KeyedTable``), dealt into buckets by
key.  A batch writes one row for each key it has, and reads the buckets of its own keys; from
time to time a bucket's rows are combined into one per key.  A batch that is run again finds
what it found the first time.  Keys never expire.

Within a batch records count in ``seq`` order; a later batch counts as arriving later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topicflow.operators import changelog
from topicflow.sources.topics import stream_topic
from topicflow.streaming import processors
from topicflow.streaming.jobs import Folders, Job, folders, start_append, start_batches, start_table
from topicflow.streaming.store import COMPACT_EVERY, KeyedTable

COUNT_STATE = "word string, state bigint"
BALANCE_STATE = "key string, state struct<timestamp: bigint, earlier_batch: bigint, earlier: bigint, amount: double>"
LATEST_STATE = "key string, state struct<batch: bigint, seq: bigint, value: string>"
VALUE_COUNT_STATE = "value string, state bigint"
CHANGES = "seq bigint, step int, value string, delta bigint"

class CarriedState:
    """A keyed state table handed from one micro-batch to the next."""

    def __init__(
        self,
        at: Folders,
        name: str,
        schema: str,
        combine: Callable[[Column], Column],
        compact_every: int = COMPACT_EVERY,
        buckets: int | None = None,
    ):
        self.path, self.schema, self.combine = at.table(f"state/{name}"), schema, combine
        self.compact_every, self.buckets = compact_every, buckets

    def table(self, spark: SparkSession) -> KeyedTable:
        schema = spark.createDataFrame([], self.schema).schema
        return KeyedTable(spark, self.path, schema, schema.names[:-1], self.combine, self.buckets, self.compact_every)

    def after(self, spark: SparkSession, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """The state that batch ``batch_id``, one of the last two, has left, of the given keys or of all."""
        table = self.table(spark)
        return table.read(batch_id) if keys is None else table.of_keys(keys, batch_id)

    def take(self, change: DataFrame, batch_id: int) -> DataFrame | None:
        """Store what batch ``batch_id`` adds and return what its keys had before."""
        return self.table(change.sparkSession).take(change, batch_id)

    def now(self, spark: SparkSession) -> DataFrame:
        """The state as the last batch has left it."""
        return self.table(spark).read()


def _counts(at: Folders) -> CarriedState:
    return CarriedState(at, "counts", COUNT_STATE, F.sum)


def _balances(at: Folders) -> CarriedState:
    return CarriedState(at, "balances", BALANCE_STATE, F.max)


def _value_counts(at: Folders) -> CarriedState:
    return CarriedState(at, "counts", VALUE_COUNT_STATE, F.sum)


def start_running_count(words: DataFrame, root: str, fresh: bool = False, **trigger) -> Job:
    """Each (word, seq, pos, ...) row with the count of its word so far."""
    at = folders(root, fresh)

    def advance(batch: DataFrame, batch_id: int) -> DataFrame:
        before = _counts(at).take(changelog.running_count_state(batch), batch_id)
        return changelog.running_count(batch, initial=before)

    schema = T.StructType(words.schema.fields + [T.StructField("n", T.LongType())])
    return start_batches(words, at, advance, schema, **trigger)


def start_running_balance(events: DataFrame, root: str, fresh: bool = False, **trigger) -> Job:
    """The account record after each (key, seq, id, amount, timestamp) event."""
    at = folders(root, fresh)

    def advance(batch: DataFrame, batch_id: int) -> DataFrame:
        before = _balances(at).take(changelog.running_balance_state(batch, batch=batch_id), batch_id)
        return changelog.running_balance(batch, initial=before, batch=batch_id)

    schema = events.select("key", "seq", "id", "amount", "timestamp").schema
    return start_batches(events, at, advance, schema, **trigger)


def start_value_counts(
    updates: DataFrame, root: str, fresh: bool = False, tombstones: bool = False, **trigger
) -> Job:
    """How many keys have each value, after each (key, seq, value) update.

    Two stateful steps with a topic of changes between them: what each update takes from
    one value and gives to another, then the running count per value.  With ``tombstones`` an
    update without a value takes its key out.
    """
    at = folders(root, fresh)
    latest = CarriedState(at, "latest", LATEST_STATE, F.max)

    def advance(batch: DataFrame, batch_id: int) -> DataFrame:
        topic = f"{at.table('changes')}/batch_id={batch_id}"
        before = latest.take(changelog.value_changes_state(batch, batch=batch_id, tombstones=tombstones), batch_id)
        found = changelog.value_changes(batch, initial=before, batch=batch_id, tombstones=tombstones)
        found.write.mode("overwrite").parquet(topic)
        changes = batch.sparkSession.read.schema(CHANGES).parquet(topic)
        return changelog.count_changes(changes, initial=_value_counts(at).take(changelog.count_changes_state(changes), batch_id))

    schema = T.StructType(
        [
            updates.schema["seq"],
            T.StructField("step", T.IntegerType()),
            updates.schema["value"],
            T.StructField("n", T.LongType()),
        ]
    )
    return start_batches(updates, at, advance, schema, **trigger)


def value_counts(spark: SparkSession, job: Job) -> DataFrame:
    """The counts :func:`start_value_counts` has arrived at; a value nobody has stays with 0."""
    return _value_counts(job.folders).now(spark).withColumnRenamed("state", "n")


def word_counts(spark: SparkSession, job: Job) -> DataFrame:
    """The counts :func:`start_running_count` has arrived at."""
    return _counts(job.folders).now(spark).withColumnRenamed("state", "n")


def balances(spark: SparkSession, job: Job) -> DataFrame:
    """Amount and timestamp that :func:`start_running_balance` has arrived at."""
    return _balances(job.folders).now(spark).select(
        "key",
        F.coalesce("state.amount", F.lit(0.0)).alias("amount"),
        F.coalesce("state.timestamp", F.lit(0).cast("bigint")).alias("timestamp"),
    )


# --- the same as two jobs ---------------------------------------------------------


def start_changes(updates: DataFrame, root: str, fresh: bool = False, tombstones: bool = False, **trigger) -> Job:
    """First job: each (key, seq, value) update becomes changes (seq, step, value, delta) in a topic of their own.

    The current value of each key is in the state store; the topic takes each change exactly once, also when a
    batch is run again.
    """
    return start_append(processors.value_changes(updates, tombstones), root, fresh, **trigger)


def start_change_counts(spark: SparkSession, changes: Job, root: str, fresh: bool = False, **options) -> Job:
    """Second job: follow the topic of changes and keep the count per value.

    It has a checkpoint of its own, so either job may stop, fall behind and go on without the other.
    """
    topic = stream_topic(spark, changes.folders.output, changes.schema)
    counts = topic.groupBy("value").agg(F.sum("delta").alias("n"))
    return start_table(counts, root, fresh, keys=["value"], **options)
