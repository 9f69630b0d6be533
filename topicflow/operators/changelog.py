"""The full sequence of updates of each keyed table, one row per arriving record.

Each function has a partner ``..._state`` giving, per key, what the next records have
to start from; passing it back as ``initial`` continues the sequence.  That is how the
streaming form carries on from one micro-batch to the next; ``batch`` numbers what has
arrived together, and a later batch arrives later whatever its sequence numbers are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from topicflow.operators.running import HOT_ROWS, combined, running
from topicflow.operators.tables import event_rank

#: The words of a record share its number, so a first slot holds 4,096 records only.
WORD_SLOT_BITS = (12, 25)


def _one() -> Column:
    return F.lit(1).cast("bigint")


def running_count(
    df: DataFrame,
    key: str = "word",
    seq: str = "seq",
    pos: str = "pos",
    out: str = "n",
    initial: DataFrame | None = None,
    **slots,
) -> DataFrame:
    """Each row with the count of its key so far, ordered by (seq, pos)."""
    rows = df.where(F.col(key).isNotNull())
    slots = {"slot_bits": WORD_SLOT_BITS} | slots
    return running(rows, [key], seq, _one(), F.sum, out, ties=[pos], initial=initial, **slots)


def running_count_state(df: DataFrame, key: str = "word") -> DataFrame:
    return combined(df.where(F.col(key).isNotNull()), [key], _one(), F.sum)


def _winning_event(timestamp: str, seq: str, amount: str, batch: int) -> Column:
    return F.when(F.col(timestamp) > 0, event_rank(timestamp, seq, amount, F.lit(batch).cast("bigint")))


def running_balance(
    df: DataFrame,
    key: str = "key",
    id: str = "id",
    amount: str = "amount",
    timestamp: str = "timestamp",
    seq: str = "seq",
    initial: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    batch: int = 0,
    **slots,
) -> DataFrame:
    """The account record after each event, unchanged where the event was late."""
    rows = df.where(F.col(key).isNotNull()).select(key, seq, id, amount, timestamp)
    newest = _winning_event(timestamp, seq, amount, batch)
    return running(
        rows, [key], seq, newest, F.max, "_newest", initial=initial, hot_rows=hot_rows, **slots
    ).select(
        key,
        seq,
        id,
        F.coalesce(F.col("_newest.amount"), F.lit(0.0)).alias(amount),
        F.coalesce(F.col("_newest.timestamp"), F.lit(0).cast("bigint")).alias(timestamp),
    )


def running_balance_state(
    df: DataFrame,
    key: str = "key",
    amount: str = "amount",
    timestamp: str = "timestamp",
    seq: str = "seq",
    batch: int = 0,
) -> DataFrame:
    return combined(df.where(F.col(key).isNotNull()), [key], _winning_event(timestamp, seq, amount, batch), F.max)


def _arrived(seq: str, value: str, batch: int) -> Column:
    # batches and, within one, seq grow, so the maximum over the rows before is the row before
    return F.struct(F.lit(batch).cast("bigint").alias("batch"), F.col(seq).alias("seq"), F.col(value).alias("value"))


def _valued(df: DataFrame, key: str, value: str, tombstones: bool = False) -> DataFrame:
    keyed = F.col(key).isNotNull()
    return df.where(keyed if tombstones else keyed & F.col(value).isNotNull())


def value_changes(
    df: DataFrame,
    key: str = "key",
    value: str = "value",
    seq: str = "seq",
    initial: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    batch: int = 0,
    tombstones: bool = False,
    **slots,
) -> DataFrame:
    """What each update does to the count of keys per value: (seq, step, value, delta).

    Step 0 takes the key out of its old value, step 1 puts it into the new one; both
    are given when the value repeats.  Updates without a value are left out, or, as ``tombstones``, take the key
    out of its old value and leave it without one.
    """
    rows = _valued(df, key, value, tombstones).select(key, seq, value)
    steps = running(
        rows,
        [key],
        seq,
        _arrived(seq, value, batch),
        F.max,
        "_old",
        before=True,
        initial=initial,
        hot_rows=hot_rows,
        **slots,
    )
    old = F.col("_old.value")
    change = F.array(
        F.when(old.isNotNull(), F.struct(F.lit(0).alias("step"), old.alias(value), (-_one()).alias("delta"))),
        F.when(F.col(value).isNotNull(), F.struct(F.lit(1).alias("step"), F.col(value), _one().alias("delta"))),
    )
    return steps.select(seq, F.explode(F.array_compact(change)).alias("_change")).select(seq, "_change.*")


def value_changes_state(
    df: DataFrame, key: str = "key", value: str = "value", seq: str = "seq", batch: int = 0, tombstones: bool = False
) -> DataFrame:
    return combined(_valued(df, key, value, tombstones), [key], _arrived(seq, value, batch), F.max)


def count_changes(
    changes: DataFrame,
    value: str = "value",
    seq: str = "seq",
    out: str = "n",
    initial: DataFrame | None = None,
    **slots,
) -> DataFrame:
    """Turn changes into the count of keys per value after each: (seq, step, value, n)."""
    counts = running(
        changes, [value], seq, F.col("delta"), F.sum, out, ties=["step"], initial=initial, **slots
    )
    return counts.select(seq, "step", value, out)


def count_changes_state(changes: DataFrame, value: str = "value") -> DataFrame:
    return combined(changes, [value], F.col("delta"), F.sum)


def running_value_count(
    df: DataFrame,
    key: str = "key",
    value: str = "value",
    seq: str = "seq",
    out: str = "n",
    hot_rows: int = HOT_ROWS,
    tombstones: bool = False,
    **slots,
) -> DataFrame:
    """How many keys have the value after each update: (seq, step, value, n)."""
    changes = value_changes(df, key, value, seq, hot_rows=hot_rows, tombstones=tombstones, **slots)
    return count_changes(changes, value, seq, out, **slots)
