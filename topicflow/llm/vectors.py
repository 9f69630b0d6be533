"""Blocks of vectors: what both searches share.

Queries and vectors are cut into blocks by a hash, and each pair of blocks is one task's
search, so a task's memory has a bound and no side is broadcast.  Equal vectors are one
candidate with its smallest ids, as many as a result can hold: a vector that a third of all
rows share is one row here.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from topicflow.llm.common import written

#: Vectors and queries of a block, on average.
VECTOR_BLOCK = 1 << 13
QUERY_BLOCK = 1 << 10

Search = Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def finite(vector: str) -> Column:
    """Whether a vector is not null and holds only finite numbers."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vector, ids) from (id, vector): each vector once, with its ``k + 1`` smallest ids, null ids left out.

    The window keeps that many rows of a vector in each task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    # repeated rows are one candidate
    kept = rows.where("id IS NOT NULL").distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return kept.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.array(column.combine_chunks().flatten(), dtype=kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def nearest(
    rows: DataFrame, k: int, search: Search, kind: type, score_type: str
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best of each query, from (id, vector, is_query).

    ``search(vectors, queries)`` yields for each query the positions and scores of the
    ``k + 1`` best of this block, as the query itself may be one of them.  Vectors are
    compared with those of as many components only.
    """
    rows = written(rows, "rows")
    queries = rows.where("is_query").select("id", "vector").distinct()
    vectors = written(distinct_vectors(rows.select("id", "vector"), k), "vectors")
    v_blocks = max(1, math.ceil(vectors.count() / VECTOR_BLOCK))
    q_blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    own = F.xxhash64("vector")
    dealt_v = vectors.select(
        F.size("vector").alias("width"),
        F.pmod(own, F.lit(v_blocks)).alias("v_block"),
        _numbers(q_blocks).alias("q_block"),
        "vector",
        "ids",
    )
    dealt_q = queries.select(
        F.size("vector").alias("width"),
        _numbers(v_blocks).alias("v_block"),
        F.pmod(F.xxhash64("id", "vector"), F.lit(q_blocks)).alias("q_block"),
        "id",
        own.alias("query_key"),
        "vector",
    )
    keys = ["width", "v_block", "q_block"]
    score_arrow = {"double": pa.float64(), "long": pa.int64()}[score_type]

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        q, v = _matrix(left.column("vector"), kind), _matrix(right.column("vector"), kind)
        out: list[list] = [[], [], [], []]
        if len(q) and len(v):
            ids = right.column("ids").to_pylist()
            q_ids, q_keys = left.column("id").to_pylist(), left.column("query_key").to_pylist()
            for i, at, scores in search(v, q):
                # best first; of equal scores the smaller ids
                found = sorted(
                    (-s, x) for s, j in zip(scores.tolist(), at.tolist()) for x in ids[j] if x != q_ids[i]
                )[:k]
                out[0] += [q_ids[i]] * len(found)
                out[1] += [q_keys[i]] * len(found)
                out[2] += [x for _, x in found]
                out[3] += [-s for s, _ in found]
        types = (pa.int64(), pa.int64(), pa.int64(), score_arrow)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "query_key", "id", "score"), out, types)})

    found = dealt_q.groupBy(*keys).cogroup(dealt_v.groupBy(*keys)).applyInArrow(
        pair, f"query_id long, query_key long, id long, score {score_type}"
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
