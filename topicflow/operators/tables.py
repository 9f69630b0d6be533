"""Keyed tables: one row per key, kept up to date by the arriving records.

The first, second and fourth function are plain grouped aggregates, so the same
code runs on a batch DataFrame and, in update mode, on a streaming one.  Partial
aggregation happens before the shuffle: a key that holds a third of all rows sends
one row per map task, not its rows.

Records arrive in ``seq`` order.  On a stream, a later micro-batch arrives later whatever
its numbers are: the time at which its micro-batch began, which Spark records with the
batch and keeps when the batch is run again, comes before ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def count_per_key(df: DataFrame, key: str = "word", out: str = "n") -> DataFrame:
    """Rows per key; null keys are skipped."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def latest_value(
    df: DataFrame, key: str = "key", value: str = "value", seq: str = "seq", tombstones: bool = False
) -> DataFrame:
    """The value that arrived last for each key.

    A key whose last update has no value stays with null, or, with ``tombstones`` (batch only), is not in the table.
    """
    rows = with_arrival(df).where(F.col(key).isNotNull())
    table = rows.groupBy(key).agg(F.max_by(value, F.struct(ARRIVED, seq)).alias(value))
    return table.where(F.col(value).isNotNull()) if tombstones else table


def count_by_current_value(
    df: DataFrame, key: str = "key", value: str = "value", seq: str = "seq", out: str = "n", tombstones: bool = False
) -> DataFrame:
    """How many keys have each value now; a value every key has left stays with 0.

    Updates without a value are left out, or, as ``tombstones``, leave their key without one.

    Two facts are needed: each key's last value, and every value ever seen.  Both are in
    the newest ``seq`` of each (key, value), which is found first, by hash and before the
    shuffle.  Two grouping sets over that smaller table then give both facts, so no
    group is ever held whole and no join is needed.
    """
    rows = df.where(F.col(key).isNotNull() if tombstones else F.col(key).isNotNull() & F.col(value).isNotNull())
    newest = rows.groupBy(key, value).agg(F.max(seq).alias(seq))
    per_set = newest.select(key, F.col(value).alias("_seen"), F.col(value).alias("_value"), seq)
    per_set = per_set.groupingSets([[key], ["_seen"]], key, "_seen").agg(
        F.max_by("_value", seq).alias("_last"), F.grouping("_seen").alias("_is_key")
    )
    return (
        per_set.select(F.when(F.col("_is_key") == 1, F.col("_last")).otherwise(F.col("_seen")).alias(value), "_is_key")
        .where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.sum(F.col("_is_key").cast("bigint")).alias(out))
    )


def latest_by_event_time(
    df: DataFrame,
    key: str = "key",
    id: str = "id",
    amount: str = "amount",
    timestamp: str = "timestamp",
    seq: str = "seq",
) -> DataFrame:
    """Fold account events into one record per key.

    The state starts at (0, 0.0, 0).  ``id`` always follows arrival order.  ``amount``
    and ``timestamp`` change only on a strictly newer timestamp: late records are
    ignored however late they are, ties keep the first arrival, and timestamps that
    are not positive never win.  No watermark: state is never expired.
    """
    newest = F.max(F.when(F.col(timestamp) > 0, event_rank(timestamp, seq, amount, F.col(ARRIVED))))
    return (
        with_arrival(df)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(id, F.struct(ARRIVED, seq)).alias(id), newest.alias("_newest"))
        .select(
            key,
            id,
            F.coalesce(F.col("_newest.amount"), F.lit(0.0)).alias(amount),
            F.coalesce(F.col("_newest.timestamp"), F.lit(0).cast("bigint")).alias(timestamp),
        )
    )


ARRIVED = "_arrived"


def with_arrival(df: DataFrame) -> DataFrame:
    """Add when the rows' micro-batch began, in microseconds; 0 in a batch DataFrame, whose rows only ``seq`` orders."""
    micros = F.unix_micros(F.current_timestamp()) if df.isStreaming else F.lit(0).cast("bigint")
    return df.withColumn(ARRIVED, micros)


def event_rank(timestamp: str, seq: str, amount: str, arrived: Column) -> Column:
    """Struct whose maximum is the newest event, first arrival among equals."""
    return F.struct(
        F.col(timestamp).alias("timestamp"),
        (-arrived).alias("earlier_batch"),
        (-F.col(seq)).alias("earlier"),
        F.col(amount).alias("amount"),
    )
