"""Per-record changelogs on Spark's state store.

The jobs in ``changelog`` keep their state in a table of files; here a key's state is a value in the state
store (RocksDB), so a micro-batch looks up its own keys and nothing else.  One processor call has all
of a key's records in the micro-batch, in memory: bound the batch (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``), and take the form in ``changelog`` where one key brings a large part of it.

The processors get whole columns (pandas form) and work on them with numpy; they run in Python workers,
which need no copy of this package.  Records count in ``seq`` order within a batch, and a later batch
arrives later.  The sink's own commit record makes each row appear once (``jobs.start_append``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> dict[str, np.ndarray]:
    """The columns of a key's records in order; most keys have few records, so frames are not built in between."""
    parts = list(rows)
    columns = {c: np.concatenate([p[c].to_numpy() for p in parts]) if len(parts) > 1 else parts[0][c].to_numpy() for c in parts[0].columns}
    if len(columns[order[0]]) == 1:
        return columns
    at = np.lexsort([columns[c] for c in reversed(order)])
    return {c: values[at] for c, values in columns.items()}


class RunningCount(StatefulProcessor):
    """Each record with the count of its key so far."""

    def __init__(self, order: list[str], out: str):
        self.order, self.out = order, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _in_order(rows, self.order)
        n = len(found[self.order[0]])
        before = (self.count.get() or (0,))[0]
        self.count.update((before + n,))
        yield pd.DataFrame(found | {self.out: before + np.arange(1, n + 1)})

    def close(self) -> None:
        pass


class RunningBalance(StatefulProcessor):
    """The account after each event: amount and time follow the newest event, the id the last one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "amount double, timestamp bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _in_order(rows, ["seq"])
        amount, time = self.newest.get() or (0.0, 0)
        times = np.maximum.accumulate(np.concatenate([[time], found["timestamp"]]))
        newer = np.where(times[1:] > times[:-1], np.arange(1, len(times)), 0)
        winners = np.concatenate([[amount], found["amount"]])[np.maximum.accumulate(newer)]
        if times[-1] > time:
            self.newest.update((float(winners[-1]), int(times[-1])))
        yield pd.DataFrame(found | {"amount": winners, "timestamp": times[1:]})

    def close(self) -> None:
        pass


class RunningBalanceRows(StatefulProcessor):
    """The same on rows: a key has a few events a batch, and frames of its own cost more than they carry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "amount double, timestamp bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        amount, time = self.newest.get() or (0.0, 0)
        before = time
        for row in sorted(rows, key=lambda r: r.seq):
            if row.timestamp > time:
                amount, time = row.amount, row.timestamp
            yield Row(key=row.key, seq=row.seq, id=row.id, amount=amount, timestamp=time)
        if time > before:
            self.newest.update((float(amount), int(time)))

    def close(self) -> None:
        pass


class ValueChanges(StatefulProcessor):
    """What each update takes from one value and gives to another; no value takes the key out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "value string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _in_order(rows, ["seq"])
        new = found["value"]
        old = np.concatenate([[(self.current.get() or (None,))[0]], new[:-1]]).astype(object)
        parts = [
            pd.DataFrame({"seq": found["seq"], "step": step, "value": values, "delta": delta})[pd.notna(values)]
            for step, values, delta in ((0, old, -1), (1, new, 1))
        ]
        if pd.isna(new[-1]):
            self.current.clear()
        else:
            self.current.update((new[-1],))
        yield pd.concat(parts, ignore_index=True)

    def close(self) -> None:
        pass


def _number(seq: str) -> Column:
    return F.coalesce(F.col(seq), F.raise_error(F.lit(f"a row without a {seq} has no place in the order")).cast("bigint"))


def _run(rows: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType | str) -> DataFrame:
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "None")


def running_count(words: DataFrame, key: str = "word", seq: str = "seq", pos: str = "pos", out: str = "n") -> DataFrame:
    """A stream of rows with the count of their key so far, ordered by (seq, pos); null keys are skipped."""
    rows = words.where(F.col(key).isNotNull()).withColumn(seq, _number(seq))
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.LongType())])
    return _run(rows, key, RunningCount([seq, pos], out), schema)


def running_balance(events: DataFrame) -> DataFrame:
    """A stream of the account after each (key, seq, id, amount, timestamp) event; null keys are skipped."""
    rows = events.where(F.col("key").isNotNull()).select(
        "key",
        _number("seq").alias("seq"),
        "id",
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        F.coalesce("timestamp", F.lit(0).cast("bigint")).alias("timestamp"),  # a time that is not positive never wins
    )
    return rows.groupBy("key").transformWithState(RunningBalanceRows(), rows.schema, "Append", "None")


def value_changes(updates: DataFrame, tombstones: bool = False) -> DataFrame:
    """A stream of (seq, step, value, delta): what each (key, seq, value) update does to the keys per value.

    Step 0 takes the key out of its old value, step 1 puts it into the new one.  Updates without a value are left
    out, or, as ``tombstones``, take the key out and have it forgotten.  Null keys are skipped.
    """
    rows = updates.where(F.col("key").isNotNull() if tombstones else F.col("key").isNotNull() & F.col("value").isNotNull())
    rows = rows.select("key", _number("seq").alias("seq"), "value")
    return _run(rows, "key", ValueChanges(), "seq bigint, step int, value string, delta bigint")
