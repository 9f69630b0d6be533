"""Exact top-k inner products by Fagin's threshold algorithm.

Each dimension's components are a sorted list.  A query reads all lists at the same depth,
from the end where its own component makes products largest.  What it meets for the first
time is scored at once over all dimensions.  No vector that has not been met can score
more than the sum of the products at the present depth; when that bound is below the k-th
best score found, the result is exact.  At equality the search goes on, as an unmet vector
might tie with a smaller id.

Components are whole numbers, floor(256 x), so sums are exact and ties are real.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.vectors import finite, nearest

NEIGHBOURS = 5
SCALE = 256
#: Rows of the lists that are read before the bound is looked at.
DEPTH = 32
#: Sums of products below it are exact in double precision.
EXACT = 1 << 53


def threshold_search(vectors: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, positions, scores) of each query's ``k + 1`` best vectors, ties included."""
    n, width = vectors.shape
    largest = max(float(np.abs(vectors).max()), float(np.abs(queries).max()))
    if width * largest * largest < EXACT:
        matrix, queries = vectors.astype(np.float64), queries.astype(np.float64)
    else:  # Python's integers have no bound; a score that a long cannot hold is an error on the way out
        matrix, queries = vectors.astype(object), queries.astype(object)
    order = np.argsort(vectors, axis=0, kind="stable").T.copy()
    want = min(k + 1, n)
    for i, query in enumerate(queries):
        live = np.flatnonzero(query != 0)
        met = np.zeros(n, bool)
        ids, scores, best = [], [], np.zeros(0, matrix.dtype)
        down = (query[live] > 0).astype(bool)
        at = 0
        while at < n:
            to = min(at + DEPTH, n)
            # ascending lists are read from the back where the query's component is positive
            front, back = order[live, at:to], order[live, n - to : n - at]
            seen = np.where(down[:, None], back[:, ::-1], front)
            mark = np.zeros(n, bool)
            mark[seen.ravel()] = True
            new = np.flatnonzero(mark & ~met)
            if not len(live):
                new, to = np.arange(n), n
            if len(new):
                met[new] = True
                ids.append(new)
                scores.append(matrix[new] @ query)
                best = np.sort(np.concatenate([best, scores[-1]]))[-want:]
            at = to
            bound = (matrix[seen[:, -1], live] * query[live]).sum() if len(live) else 0
            if len(best) == want and bound < best[0]:
                break
            if met.all():
                break
        ids, scores = np.concatenate(ids), np.concatenate(scores)
        kept = scores >= best[0]
        yield i, ids[kept], np.array([int(s) for s in scores[kept]], object)


def top_products(
    df: DataFrame, is_query: Column, k: int = NEIGHBOURS, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of floor(256 x), ties to the smaller id.

    Null vectors and ids, empty vectors and those with null or non-finite components take no part;
    zero vectors do.  A query is no candidate of its own, nor are other rows with its id; repeated
    rows are one.  Vectors of other lengths are no candidates.  A query without candidates has no
    rows.  Components or scores that a long cannot hold are an error.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("is_query"))
    rows = rows.where(F.col("id").isNotNull() & finite("vector"))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    found = nearest(
        rows.select("id", whole.alias("vector"), "is_query"), k, lambda v, q: threshold_search(v, q, k), np.int64, "long"
    )
    return found.withColumnRenamed("id", "vec_id")
