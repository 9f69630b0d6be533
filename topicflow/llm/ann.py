"""Approximate nearest neighbours by collision counting.

Each vector is projected onto random lines; each line's projections are a sorted array.  A
query's own projection is the centre of a window on each line.  Vectors in the window
collide with the query there, and those that collide on enough lines are verified by their
inner product.  Windows widen by virtual rehashing: the next radius extends each window
at both ends, and only what it adds is counted.  The search ends when the k-th best
verified vector is no farther than the radius, at which nearly all vectors as near as
that have had enough collisions.

Largest inner product becomes smallest distance by giving each vector one more component
that brings it to the block's largest norm, and scaling the query to that norm.

Each block of vectors is an index of its own, built by the task that searches it, and
covers all its vectors: nothing is fitted on a sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.vectors import finite, nearest

NEIGHBOURS = 20
LINES = 24
#: Collisions that make a candidate.  At distance R a window of half-width R holds a vector with
#: probability 0.68 on each line, so 13 of 24 lines do in 95 of 100 cases, and more often what is nearer.
COLLISIONS = 13
#: Cosines of candidates whose scores are computed exactly in the end may be so much less than the k-th.
SLACK = 1e-9
#: Each radius is so many times the one before.
WIDEN = 1.2
#: The first radius, as a share of the block's largest norm.
FIRST_RADIUS = 0.5
#: Radii before the one that holds everything, and queries whose windows are found together.
ROUNDS, QUERIES_AHEAD = 14, 256
SEED = 7


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (vectors * query).sum(axis=1)  # each row by itself, so equal to what the row alone would give


def _windows(
    queries: np.ndarray, directions: np.ndarray, sorted_: np.ndarray, radii: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The queries at length 1, and by line, query and radius where their windows begin and end."""
    units = queries / 2.0 ** np.frexp(np.abs(queries).max(axis=1, keepdims=True))[1]
    units = units / np.sqrt((units**2).sum(axis=1, keepdims=True))
    centres = (units @ directions).T[:, :, None]
    low = np.stack([np.searchsorted(row, c - radii) for row, c in zip(sorted_, centres)])
    high = np.stack([np.searchsorted(row, c + radii, "right") for row, c in zip(sorted_, centres)])
    return units, low, high


def collision_search(
    vectors: np.ndarray, queries: np.ndarray, k: int, lines: int = LINES, collisions: int = COLLISIONS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, positions, inner products) of each query's ``k + 1`` best verified vectors, ties included."""
    n, width = vectors.shape
    # by powers of two, which change no digit: squares of what is left neither overflow nor vanish
    scale = 2.0 ** np.frexp(np.abs(vectors).max())[1]
    scaled = vectors / scale
    norms = np.sqrt((scaled**2).sum(axis=1))
    top = norms.max()
    directions = np.random.default_rng(SEED).standard_normal((width + 1, lines))
    lift = np.sqrt(np.maximum(0, (top - norms) * (top + norms)))
    projected = np.column_stack([scaled / top, lift / top]) @ directions
    order = np.argsort(projected, axis=0, kind="stable").T.copy()
    sorted_ = np.take_along_axis(projected.T, order, axis=1)
    want = min(k + 1, n)
    radii = np.append(FIRST_RADIUS * WIDEN ** np.arange(ROUNDS), np.inf)
    for i, query in enumerate(queries):
        if i % QUERIES_AHEAD == 0:
            units, low, high = _windows(queries[i : i + QUERIES_AHEAD], directions[:width], sorted_, radii)
        unit = units[i % QUERIES_AHEAD]
        lows, highs = low[:, i % QUERIES_AHEAD], high[:, i % QUERIES_AHEAD]
        counts = np.zeros(n, np.int64)
        done = np.zeros(n, bool)
        ids, cosines = [], []
        held, found = 0, np.zeros(0)
        for step, radius in enumerate(radii):
            # what this radius adds to each line's window, at both ends
            added = []
            for line in range(lines):
                left, right = lows[line, step], highs[line, step]
                if step:
                    added += [order[line, left : lows[line, step - 1]], order[line, highs[line, step - 1] : right]]
                else:
                    added.append(order[line, left:right])
            counts += np.bincount(np.concatenate(added), minlength=n)
            new = np.flatnonzero((counts >= collisions) & ~done)
            if len(new):
                done[new] = True
                ids.append(new)
                cosines.append(scaled[new] @ unit / top)
                held += len(new)
                found = np.concatenate([found, cosines[-1]])
            if held == n:
                break
            if held >= want:
                found = np.partition(found, len(found) - want)[len(found) - want :]
                # the distance of the k-th, with the query at the same norm as the vectors
                if math.sqrt(max(0.0, 2 - 2 * found[0])) <= radius:
                    break
        ids, cosines = np.concatenate(ids), np.concatenate(cosines)
        if len(ids) > want:  # by more than products of whole blocks can differ from those of single rows
            least = np.partition(cosines, len(cosines) - want)[len(cosines) - want]
            ids = ids[cosines >= least - SLACK]
        scores = _scores(vectors[ids], query)
        if len(scores) > want:
            kept = scores >= np.partition(scores, len(scores) - want)[len(scores) - want]
            ids, scores = ids[kept], scores[kept]
        yield i, ids, scores


def nearest_neighbours(
    df: DataFrame, is_query: Column, k: int = NEIGHBOURS, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found, ties to the smaller id.

    Null vectors and ids, empty and zero vectors and those with null or non-finite components take no part.
    A query is no candidate of its own, nor are other rows with its id; repeated rows are one.
    Vectors of other lengths are no candidates.  A query without candidates has no rows.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("is_query"))
    rows = rows.where(F.col("id").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0))
    found = nearest(
        rows.select("id", F.transform("vector", lambda x: x.cast("double")).alias("vector"), "is_query"),
        k,
        lambda v, q: collision_search(v, q, k),
        np.float64,
        "double",
    )
    return found.withColumnRenamed("id", "vec_id")
