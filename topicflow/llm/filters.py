"""What filters do to each other, whatever their order.

Every document has a set of filters that it fails.  There are few such sets, so the documents
are counted by set once, and everything else follows from the counts.  Which documents
survive depends on which filters are active, not on their order: the walk visits all subsets
of filters in Gray-code order, where each differs from the one before by one filter.  Toggling
a filter moves the counter of active failures of the sets that hold it; a set whose counter
leaves zero is taken out of the running survivors, one whose counter returns to zero is put
back.  The survivors of all subsets are stored, and a step of an order is the difference of two.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.common import written

#: Fixed rules: white space that separates words, and the marks of filter D.
SPACE = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
#: A text with more than one in this many of all rows is looked up in a broadcast table, which so has fewer rows than this.
HOT_PART = 1024

RESULT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails, by filter: few words, repeated words, capitals, marks."""
    words = F.array_remove(F.split(text, SPACE), "")
    count = F.size(words)
    return {
        "A": count < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * count,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike(MARKS),
    }


def survivors(cells: np.ndarray, filters: int) -> np.ndarray:
    """What survives each subset of filters (rows by subset), of counts by failed set (rows by set)."""
    sets = np.arange(1 << filters)
    failures = np.zeros(1 << filters, np.int64)  # active filters that each set fails
    running = cells.sum(axis=0)
    found = np.zeros_like(cells)
    found[0] = running
    active = 0
    for i in range(1, 1 << filters):
        after = i ^ (i >> 1)
        bit = active ^ after
        on = bool(after & bit)
        failures[(sets & bit) != 0] += 1 if on else -1
        moved = ((sets & bit) != 0) & (failures == (1 if on else 0))
        running = running + (-1 if on else 1) * cells[moved].sum(axis=0)
        found[after] = running
        active = after
    return found


def steps(cells: np.ndarray, names: str) -> dict[str, list]:
    """The columns of the result for one part; ``cells``: rows by failed set of (all, good, toxic)."""
    states = survivors(cells, len(names))
    whole = (1 << len(names)) - 1
    rows, share = [], dict.fromkeys(names, 0)
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << names.index(name)
            removed = states[before] - states[before | bit]
            failing = states[0] - states[bit]
            alone = states[whole ^ bit] - states[whole]
            before |= bit
            share[name] += int(removed[0])
            rows.append(("".join(order), step, states[before][0], removed[0], failing[0] - removed[0], alone[0], removed[1], removed[2], name))
    columns = "filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    found = dict(zip(columns, map(list, zip(*rows))))
    found["shapley"] = [share[name] for name in found["shapley"]]
    return found


def interaction_audit(cells: DataFrame, names: str) -> DataFrame:
    """Every order of the filters, step by step, of ``cells`` (part, failed, n, good, toxic): counts by failed set.

    A part is one group of at most ``2 ** len(names)`` rows.
    """
    size = 1 << len(names)

    def walk(key: tuple, rows: pa.Table) -> pa.Table:
        counts = np.zeros((size, 3), np.int64)
        columns = [rows.column(c).to_numpy() for c in ("n", "good", "toxic")]
        np.add.at(counts, rows.column("failed").to_numpy(), np.stack(columns, axis=1))
        found = steps(counts, names)
        schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [
            (c, pa.int64()) for c in "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
        ])
        return pa.table({"part": [key[0].as_py()] * len(found["step"]), **found}, schema)

    return cells.groupBy("part").applyInArrow(walk, RESULT)


def _copies(rows: DataFrame) -> DataFrame:
    """Add ``first`` to rows (id, same, ...): the smallest id of the rows alike in ``same``, if there are several.

    The few values that hold a large part of all rows are looked up in a broadcast table, of fewer
    than ``HOT_PART`` rows, so no task gets all copies of a text.
    """
    firsts = rows.groupBy("same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = written(firsts, "firsts")
    many = F.col("copies") > max(1, rows.count() // HOT_PART)
    hot = F.broadcast(firsts.where(many).select("same", "first"))
    cold = rows.join(hot, "same", "left_anti").join(firsts.where(~many).select("same", "first"), "same", "left")
    return rows.join(hot, "same").unionByName(cold)


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    part: str = "lang",
    filters: Mapping[str, Column] | None = None,
    copies: str = "E",
) -> DataFrame:
    """Every order of the filters, step by step, for each value of ``part``.

    ``filters`` maps names of one letter to conditions under which a row fails, on the columns of
    ``docs`` (null: it does not); by default those of :func:`text_filters`.  A further one, ``copies``, fails rows whose
    text a smaller id has, anywhere in the table.  ``labels`` has ``quality`` and ``toxic`` by id.

    Null texts and parts count as empty.  A row without an id fails ``copies`` if its text has an id
    elsewhere, and has no labels; rows that repeat an id count each, and none is smaller than the other.
    An id labelled several times is good, or toxic, if one of its labels says so.  An empty table gives
    no rows; other columns do not matter.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    filters = dict(filters or text_filters(whole))
    names = "".join([*filters, copies])
    bits = [F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(filters.values())]
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        sum(bits[1:], bits[0]).alias("failed"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("same"),
    )
    rows = _copies(written(rows, "failed"))
    again = F.col("first").isNotNull() & F.coalesce(F.col("id") > F.col("first"), F.lit(True))
    rows = rows.withColumn("failed", F.col("failed") + F.when(again, F.lit(1 << len(filters))).otherwise(F.lit(0)))
    # one row for each id and failed set, so no id brings many rows to the join
    rows = rows.groupBy("id", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col(id).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = rows.join(known, "id", "left")

    def lost(label: str) -> Column:
        return F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(F.lit(0))).alias(label)

    cells = rows.groupBy("part", "failed").agg(F.sum("n").alias("n"), lost("good"), lost("toxic"))
    return interaction_audit(cells, names)
