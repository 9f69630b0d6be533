"""Topic writers, batch and streaming, and peeking at the rows that pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from topicflow.functions.wire import encode_long


def text_records(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """(string key, string value) for a topic."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def count_records(df: DataFrame, key: str = "word", count: str = "n") -> DataFrame:
    """(string key, count as 8 bytes) for a topic."""
    return df.select(F.col(key).cast("string").alias("key"), encode_long(F.col(count)).alias("value"))


def typed_records(df: DataFrame, key: str, partition: Column | None = None) -> DataFrame:
    """The record's own columns with its key as text and, if given, the partition chosen for it."""
    rows = df.withColumn("key", F.col(key).cast("string"))
    return rows if partition is None else rows.withColumn("partition", partition.cast("int"))


def write_topic(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write records to a file topic, in one folder per chosen partition if there is one."""
    writer = df.write.mode(mode)
    if "partition" in df.columns:
        writer = writer.partitionBy("partition")
    writer.parquet(path)


def append_topic(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a file topic, each record exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if "partition" in df.columns:
        writer = writer.partitionBy("partition")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_kafka(df: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    """Write (key, value[, partition]) records to Kafka (needs ``spark-sql-kafka``)."""
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer.options(**(options or {})).save()


def stream_to_kafka(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = False,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Stream records to Kafka.  Delivery is at least once: readers drop repeats by (key, seq)."""
    writer = (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .outputMode(output_mode)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def peek(df: DataFrame, name: str | Observation, **metrics: Column) -> DataFrame:
    """Pass the rows on unchanged and count them (and take ``metrics``) as they go by.

    With an ``Observation`` the result of a batch run is in ``observation.get``; with a
    name, a streaming run reports it in each progress event.
    """
    extra = [column.alias(alias) for alias, column in metrics.items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *extra)


def peek_console(df: DataFrame, rows: int = 20) -> StreamingQuery:
    """Print some rows of each micro-batch, for debugging."""
    return df.writeStream.format("console").outputMode("append").option("numRows", rows).start()
