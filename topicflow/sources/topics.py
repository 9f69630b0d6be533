"""The topic table and its readers.

Every flow starts from one schema, batch or streaming::

    topic STRING, partition INT, offset BIGINT, key STRING, value STRING, seq BIGINT

``seq`` is the total arrival order the keyed tables need.  A topic is stored as
Parquet files (one directory) or read from Kafka when that package is on the cluster.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from topicflow.operators.ordering import numbered

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

MAX_FILES_PER_TRIGGER = 1000
MAX_OFFSETS_PER_TRIGGER = 100_000_000


def read_topic(spark: SparkSession, path: str, schema: T.StructType = TOPIC_SCHEMA) -> DataFrame:
    """Everything a file topic holds now."""
    return spark.read.schema(schema).parquet(path)


def stream_topic(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TOPIC_SCHEMA,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Subscribe to a file topic from its beginning; a checkpoint continues where it stopped.

    The file limit bounds a micro-batch, and so what one key can bring to one task.
    """
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    )


def _kafka_columns(df: DataFrame, partitions: int, by_time: bool = False) -> DataFrame:
    rows = df.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )
    return with_time_order(rows).drop("timestamp") if by_time else with_arrival_order(rows.drop("timestamp"), partitions)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    partitions: int,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Subscribe to a Kafka topic from the earliest offset (needs ``spark-sql-kafka``).

    ``options`` go to the source as they are, such as ``kafka.security.protocol``.
    """
    df = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .options(**(options or {}))
        .load()
    )
    return _kafka_columns(df, partitions)


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    assigned: Sequence[int],
    partitions: int,
    starting_offsets: str = "earliest",
    options: Mapping[str, str] | None = None,
    by_time: bool = False,
) -> DataFrame:
    """Bounded read of the assigned partitions up to their present ends (needs ``spark-sql-kafka``).

    ``starting_offsets`` may be the text from :func:`starting_offsets_json`; ``options`` may set the ends, as those of
    ``progress.Read.kafka_options`` do.  ``by_time`` orders the records by broker time, partition and offset.
    """
    df = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("assign", json.dumps({topic: list(assigned)}))
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", "latest")
        .options(**(options or {}))
        .load()
    )
    return _kafka_columns(df, partitions, by_time)


def with_arrival_order(df: DataFrame, partitions: int) -> DataFrame:
    """Add ``seq`` to a topic of ``partitions`` partitions.

    Order is defined within a partition only, so any fixed interleaving is a valid one.
    This one takes the partitions in turn, offset by offset: it needs no shuffle, gives
    the same numbers on every run and leaves no large gaps.
    """
    return df.withColumn("seq", F.col("offset") * F.lit(partitions).cast("bigint") + F.col("partition"))


def with_time_order(df: DataFrame, time: str = "timestamp", ranges: int | None = None) -> DataFrame:
    """Add ``seq`` to a bounded topic: dense numbers by (broker time, partition, offset), the same on every run.

    Equal times are told apart by partition and offset; records without a time come first.  The rows are
    dealt into ranges of the order, sorted there and stored (:func:`topicflow.operators.ordering.numbered`).
    """
    return numbered(df, [time, "partition", "offset"], "seq", ranges=ranges)


def assigned_partitions(df: DataFrame, partitions: Sequence[int]) -> DataFrame:
    """Key and value of the given partitions, with their place in the topic."""
    return df.where(F.col("partition").isin(list(partitions)))


def translate(df: DataFrame) -> DataFrame:
    """Records as (topic, offset, key, message, partition)."""
    return df.select("topic", "offset", "key", F.col("value").alias("message"), "partition")


def partition_progress(df: DataFrame) -> DataFrame:
    """The next offset to read, per topic and partition."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def unread(df: DataFrame, progress: DataFrame) -> DataFrame:
    """Records at or after the stored progress; partitions without any are read whole.

    The progress table has one row per partition, so Spark broadcasts it by its size.
    """
    rows = df.join(progress.select("topic", "partition", "next_offset"), ["topic", "partition"], "left")
    kept = rows.where(F.col("next_offset").isNull() | (F.col("offset") >= F.col("next_offset")))
    return kept.select(*df.columns)


EARLIEST = -2


def starting_offsets_json(progress: DataFrame, assigned: Mapping[str, Sequence[int]] | None = None) -> str:
    """Progress as the ``startingOffsets`` text of a Kafka read.

    Kafka wants a start for each assigned partition and for no other: with ``assigned``, those
    without progress start at their earliest offset and progress of others is left out.
    Brings one row per partition to the driver, which is where Kafka wants it.
    """
    offsets = {topic: {str(p): EARLIEST for p in parts} for topic, parts in (assigned or {}).items()}
    for row in progress.select("topic", "partition", "next_offset").toLocalIterator():
        topic, partition = row["topic"], str(row["partition"])
        if assigned is None:
            offsets.setdefault(topic, {})[partition] = row["next_offset"]
        elif partition in offsets.get(topic, {}):
            offsets[topic][partition] = row["next_offset"]
    return json.dumps(offsets)


def spread(
    df: DataFrame, parallelism: int | None = None, by: Sequence[str] = (), at_least: int | None = None
) -> DataFrame:
    """Redistribute rows: by the values of ``by``, or round-robin to ``parallelism`` parts.

    Without either the rows stay where they are: how many splits an input has is for its files
    and ``spark.sql.files.maxPartitionBytes`` to say.  ``at_least`` is for work that is dearer than moving its
    input, on a table as it is read: where that comes in fewer parts than so many, as one small file does, they
    are made so many; a table of many splits is not moved.
    """
    if by:
        return df.repartition(parallelism, *by) if parallelism else df.repartition(*by)
    if at_least and df.rdd.getNumPartitions() < at_least:
        parallelism = at_least
    return df.repartition(parallelism) if parallelism else df
