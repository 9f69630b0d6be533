"""Stateful keyed jobs: start, stop, resume, and read what they have written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from topicflow.session import use_rocksdb
from topicflow.streaming.store import KeyedTable


@dataclass(frozen=True)
class Folders:
    """Where a job keeps its progress and state, and where it writes."""

    base: str

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"

    @property
    def output(self) -> str:
        return f"{self.base}/output"

    def table(self, name: str) -> str:
        return f"{self.base}/{name}"


def folders(root: str, fresh: bool = False) -> Folders:
    """The job's folders below ``root``.

    Starting again with the same ``root`` resumes.  ``fresh`` takes new folders, so the
    job meets no earlier progress, state or output.
    """
    return Folders(f"{root}/fresh-{uuid.uuid4().hex}" if fresh else f"{root}/main")


@dataclass
class Job:
    """A started query, its folders and the schema of its output."""

    query: StreamingQuery
    folders: Folders
    schema: T.StructType
    keys: tuple[str, ...] = ()

    def wait(self) -> "Job":
        self.query.awaitTermination()
        return self


def _writer(df: DataFrame, mode: str, at: Folders, available_now: bool, interval: str):
    use_rocksdb(df.sparkSession)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", at.checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_batches(
    rows: DataFrame,
    at: Folders,
    advance: Callable[[DataFrame, int], DataFrame],
    schema: T.StructType,
    mode: str = "append",
    available_now: bool = True,
    interval: str = "10 seconds",
    keep: bool = True,
) -> Job:
    """Run ``advance`` on each micro-batch and write what it returns.

    A batch goes to a folder named by its id and replaces what is there, so a batch that
    is run again after a failure leaves the same rows, once.  With ``keep`` the batch is kept
    while it is worked on, so its source is read once however often ``advance`` uses it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if keep:
            batch.persist()
        try:
            advance(batch, batch_id).write.mode("overwrite").parquet(f"{at.output}/batch_id={batch_id}")
        finally:
            if keep:
                batch.unpersist()

    query = _writer(rows, mode, at, available_now, interval).foreachBatch(write).start()
    return Job(query, at, schema)


def _output_table(spark: SparkSession, at: Folders, schema: T.StructType, keys: Sequence[str], **layout) -> KeyedTable:
    """Where a job keeps its table: per key the values with the micro-batch that wrote them, of which the last counts."""
    values = [T.StructField("batch_id", T.LongType()), *(f for f in schema.fields if f.name not in keys)]
    stored = T.StructType([schema[k] for k in keys] + [T.StructField("state", T.StructType(values))])
    return KeyedTable(spark, at.table("table"), stored, keys, lambda s: F.max_by(s, s["batch_id"]), **layout)


def start_table(
    table: DataFrame,
    root: str,
    fresh: bool = False,
    keys: Sequence[str] = (),
    available_now: bool = True,
    interval: str = "10 seconds",
    **layout,
) -> Job:
    """Run a keyed table as a stream; each micro-batch writes the keys that changed.

    With ``keys`` the updates go into a table that holds each key once (:mod:`topicflow.streaming.store`; ``buckets``
    and ``compact_every`` are its layout), and superseded files are deleted.  Without, every update is kept, for
    :func:`read_updates`, and reading the table scans them all.

    State is kept per shuffle partition in RocksDB.  The number of shuffle partitions is
    fixed by the first run of a checkpoint, so choose it for the size the state will have.
    """
    at, spark, schema = folders(root, fresh), table.sparkSession, table.schema
    if not keys:
        run = {"available_now": available_now, "interval": interval}
        return start_batches(table, at, lambda batch, _: batch, schema, mode="update", keep=False, **run)
    values = [F.col(c) for c in schema.names if c not in keys]
    stored = _output_table(spark, at, schema, keys, **layout)

    def write(batch: DataFrame, batch_id: int) -> None:
        state = F.struct(F.lit(batch_id).cast("bigint").alias("batch_id"), *values)
        stored.put(batch.select(*keys, state.alias("state")), batch_id)

    query = _writer(table, "update", at, available_now, interval).foreachBatch(write).start()
    return Job(query, at, schema, tuple(keys))


def start_append(
    rows: DataFrame, root: str, fresh: bool = False, available_now: bool = True, interval: str = "10 seconds"
) -> Job:
    """Run a stream of new rows into a file topic, each row exactly once."""
    at = folders(root, fresh)
    query = _writer(rows, "append", at, available_now, interval).format("parquet").start(at.output)
    return Job(query, at, rows.schema)


def read_updates(spark: SparkSession, job: Job) -> DataFrame:
    """Every row written by :func:`start_batches`, with the micro-batch it came from."""
    schema = T.StructType(job.schema.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(job.folders.output)


def read_table(spark: SparkSession, job: Job, keys: Sequence[str]) -> DataFrame:
    """The table as :func:`start_table` has left it: the newest update per key."""
    names = job.schema.fieldNames()
    if job.keys:
        return _output_table(spark, job.folders, job.schema, job.keys).read().select(*job.keys, "state.*").select(*names)
    newest = F.max_by(F.struct(*[c for c in names if c not in keys]), "batch_id").alias("_newest")
    updates = read_updates(spark, job).groupBy(*keys).agg(newest)
    return updates.select(*keys, "_newest.*").select(*names)


def read_rows(spark: SparkSession, job: Job) -> DataFrame:
    """Every row written so far, without the micro-batch it came from."""
    return spark.read.schema(job.schema).parquet(job.folders.output).select(*job.schema.fieldNames())
