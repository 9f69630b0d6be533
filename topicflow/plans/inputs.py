"""Topics and records built from the given tables.

Each function takes a reader, ``table(name, *columns)``, so that the same projection
serves the batch table and the stream over it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow.functions.wire import epoch_micros
from topicflow.sources.topics import with_arrival_order

Reader = Callable[..., DataFrame]

EVENT_PARTITIONS = 3
# Fixed value: the colours that count.
COLOURS = ["RED", "BLUE", "GREEN"]
# The event types that take the colours' place in the given tables.
EVENT_COLOURS = ["CLICK", "VIEW", "PURCHASE"]


def batch_reader(spark: SparkSession, sf_dir: str) -> Reader:
    return lambda name, *columns: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stream_reader(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1000) -> Reader:
    def read(name: str, *columns: str) -> DataFrame:
        schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
        # a pattern, because a stream reads a plain path as a folder and the table may be one file
        path = f"{sf_dir}/{name}.parque[t]"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
        return stream.parquet(path).select(*columns)

    return read


def documents(table: Reader) -> DataFrame:
    return table("documents", F.col("text").alias("value"))


def conversations(table: Reader) -> DataFrame:
    """Conversation turns as a topic: one record per turn, keyed by conversation."""
    seq = F.shiftleft("conv_id", 32) + F.col("turn")  # a turn is an int, so no two records share a number
    return table(
        "conversations",
        F.lit("conversations").alias("topic"),
        (F.col("conv_id") % 3).cast("int").alias("partition"),
        seq.alias("offset"),
        F.col("conv_id").cast("string").alias("key"),
        F.col("text").alias("value"),
        seq.alias("seq"),
    )


def events(table: Reader) -> DataFrame:
    """Events as a topic of three partitions."""
    rows = table(
        "events",
        F.lit("events").alias("topic"),
        (F.col("event_id") % EVENT_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / EVENT_PARTITIONS).alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
    )
    return with_arrival_order(rows, EVENT_PARTITIONS)


def timed_events(table: Reader) -> DataFrame:
    """The event topic with a coarse broker time, so that many records of several partitions share one."""
    return table(
        "events",
        F.lit("events").alias("topic"),
        (F.col("event_id") % EVENT_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / EVENT_PARTITIONS).alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.date_trunc("hour", "ts").alias("timestamp"),
    )


def colour_lines(table: Reader) -> DataFrame:
    """``user,type,x`` lines from the events, with null, separator-less and one-part lines among them."""
    id, user = F.col("event_id"), F.col("user_id").cast("string")
    line = (
        F.when(id % 17 == 0, F.lit(None).cast("string"))
        .when(id % 13 == 0, F.lit("nocomma"))
        .when(id % 11 == 0, F.concat(user, F.lit(",")))
        .otherwise(F.concat(user, F.lit(","), F.col("event_type"), F.lit(",x")))
    )
    return table("events", id.alias("seq"), line.alias("line"))


def account_events(table: Reader) -> DataFrame:
    """Orders as account events: customers are the accounts, and most orders arrive late."""
    return table(
        "orders",
        F.col("o_custkey").cast("string").alias("key"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").cast("int").alias("id"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_totalprice").alias("amount"),
        epoch_micros(F.col("o_orderdate")).alias("timestamp"),
    )


def payments(table: Reader) -> DataFrame:
    """Customers as payment records with fields left unset."""
    k = F.col("c_custkey")

    def unset_each(n: int, value):
        return F.when(k % n != 0, value)

    return table(
        "customer",
        unset_each(19, k.cast("string")).alias("id"),
        unset_each(3, F.col("c_name")).alias("name"),
        unset_each(5, F.col("c_acctbal")).alias("amount"),
        unset_each(7, F.col("c_mktsegment")).alias("profile"),
        F.lit(None).cast("int").alias("salary"),
    )
