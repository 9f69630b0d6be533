"""Running totals per key that never hold one key's rows in one task.

A window over ``partitionBy(key)`` sends every row of a frequent key to one task.
Here the order column is cut into slots of consecutive sequence numbers, and the window
runs over (key, slot).  What a slot inherits from earlier slots comes from one combined
row per (key, slot), and those rows are prefix-combined by the same function again with
slots of slots.

``slot_bits`` gives the width of each level's slots.  The default of 21 and two levels leave
21 bits of a 63-bit sequence number for the last window: no window holds more than 2**21
sequence numbers, slots or slots of slots of a key, however sparse the numbers are.  Rows
that share a sequence number (the words of one record) share a slot, so callers with such
rows take narrower first slots.

Which keys to cut is the caller's choice:

* all of them, where keys repeat so much that a slot has far fewer keys than rows
  (words, colours): one extra pass over the input;
* only keys with more than ``hot_rows`` rows, where most keys are rare (accounts,
  users).  A key's rows are summed up from the same combined rows per (key, slot) that the
  slots inherit from.  The table of hot keys is joined without a hint: Spark broadcasts it if it
  measures small, and else splits the skewed side of the join.

Slots are computed from the sequence number alone, so a task that is run again after
an executor loss puts every row in the same slot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_BITS = 21
LEVELS = 2
HOT_ROWS = 1 << 20


def running(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    combine: Callable[[Column], Column],
    out: str,
    ties: Sequence[str] = (),
    before: bool = False,
    initial: DataFrame | None = None,
    hot_rows: int | None = None,
    slot_bits: int | Sequence[int] = SLOT_BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """Add ``out``: ``combine`` of ``value`` over the key's rows up to this one.

    ``seq`` must be an integer column; a row without a number has no place in the order and is an
    error (see :func:`unordered`).  ``ties`` order rows within one sequence number.  ``combine`` is
    ``F.sum`` or ``F.max`` (or anything else that can combine its own results and skips nulls).
    With ``before`` the current row is left out, and the first row of a key gets null.
    ``initial`` holds what a key starts from: one row per key, the keys and a column ``state``.
    ``slot_bits``: one width for ``levels`` levels, or a width for each level, the finest first.
    """
    bits = [slot_bits] * levels if isinstance(slot_bits, int) else list(slot_bits)
    number = F.coalesce(F.col(seq), F.raise_error(F.lit(f"a row without a {seq} has no place in the order")))
    ordered = df.withColumn(seq, number.cast(df.schema[seq].dataType))
    return _running(ordered, list(keys), seq, value, combine, out, ties, before, initial, hot_rows, bits)


def unordered(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The rows that cannot be put in order, for a caller that sets them aside."""
    return df.where(F.col(seq).isNull())


def _running(
    df: DataFrame,
    keys: list[str],
    seq: str,
    value: Column,
    combine: Callable[[Column], Column],
    out: str,
    ties: Sequence[str],
    before: bool,
    initial: DataFrame | None,
    hot_rows: int | None,
    bits: list[int],
) -> DataFrame:
    columns = df.columns
    if not bits:
        groups, rows = keys, df.withColumn("_value", value)
        starts = initial and initial.select(*keys, F.col("state").alias("_value"))
    else:
        slot = f"_slot{len(bits)}"
        groups = [*keys, slot]
        number = F.shiftright(F.col(seq), bits[0])
        rows = df.withColumns({"_value": value, slot: number})
        per_slot = rows.groupBy(*groups).agg(combine(F.col("_value")).alias("state"), F.count(F.lit(1)).alias("_rows"))
        cold_starts = None
        if hot_rows is not None:
            hot = per_slot.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))
            hot = hot.where(F.col("_rows") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
            rows = rows.join(hot, keys, "left").withColumn(slot, F.when(F.col("_hot"), F.col(slot)).otherwise(F.lit(0)))
            per_slot = per_slot.join(hot, keys, "left_semi")
            if initial is not None:
                cold_starts = initial.join(hot, keys, "left_anti").select(
                    *keys, F.lit(0).cast("bigint").alias(slot), F.col("state").alias("_value")
                )
                initial = initial.join(hot, keys, "left_semi")
        inherited = _running(
            per_slot.drop("_rows"), keys, slot, F.col("state"), combine, "_value", (), True, initial, None, bits[1:]
        )
        starts = inherited.select(*groups, "_value").where(F.col("_value").isNotNull())
        if cold_starts is not None:
            starts = starts.unionByName(cold_starts)

    # what a group starts from enters its window as an extra row, marked as such and first
    rows = rows.withColumn("_is_row", F.lit(1))
    if starts is not None:
        rows = rows.unionByName(starts.withColumn("_is_row", F.lit(0)), allowMissingColumns=True)
    order = (
        Window.partitionBy(*groups)
        .orderBy("_is_row", seq, *ties)
        .rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    )
    return rows.withColumn(out, combine(F.col("_value")).over(order)).where("_is_row = 1").select(*columns, out)


def combined(df: DataFrame, keys: Sequence[str], value: Column, combine: Callable[[Column], Column]) -> DataFrame:
    """One row per key with the combination of all its values as ``state``."""
    return df.groupBy(*keys).agg(combine(value).alias("state"))
