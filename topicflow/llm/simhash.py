"""SimHash near-duplicates by a binary trie joined with itself.

A text's fingerprint has bit ``i`` set where more than half of its word shingles' hashes
have it set.  Two texts link when their fingerprints differ in few bits.

All fingerprints form a binary trie, one level per bit.  The join walks pairs of nodes of
the same depth from (root, root): a pair's children are paired up, a pair whose children
took different bits has spent one more bit of the budget, and a pair over budget is
dropped with everything below it.  Where both nodes hold few fingerprints the walk ends
and these are compared whole.

On Spark the first levels of the walk, more of them the more fingerprints there are, are done
by a shuffle: each distinct fingerprint goes to every pair of top nodes within budget, and each
such pair of nodes is one task's trie walk over two sorted arrays.  A walk returns not its links but
a spanning forest of them, at most one row per fingerprint, so a dense group costs no more rows
than it has members.  Equal fingerprints are one trie leaf, however many texts have them.
Groups are the connected components of the forests' edges, found by star contraction over
tables in the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from topicflow.llm.common import fresh_name, utf8, written

BITS = 64
SHINGLE_WORDS = 4
MAX_DIFFERING = 4
#: Levels of the trie that the shuffle deals out at least (16 top nodes, 136 pairs) and at most, and how many
#: fingerprints a pair of top nodes should not exceed, on average.
TOP_BITS, MOST_TOP_BITS = 4, 16
PAIR_FINGERPRINTS = 1 << 21
#: Pairs of nodes that hold no more pairs of fingerprints than this are compared whole.
LEAF_PAIRS = 256
#: Pairs of nodes, or of fingerprints, that a walk holds at a time.
CHUNK = 1 << 18
HASH_SEED = 42
#: Shingles that are unpacked into bits at a time.
SHINGLE_BLOCK = 1 << 16


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text; zero if it has no words."""
    found = text.lower().split()  # on bytes: A-Z only, and white space is 0x20 and 0x09-0x0D
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = list(accumulate((len(w) + 1 for w in found), initial=-1))  # ends[i + 1]: where word i ends
    starts = [e + 1 for e in ends[:-1]]
    ends = ends[words:]
    digest = xxhash.xxh64_intdigest
    total, ones = len(ends), np.zeros(BITS, np.int64)
    for at in range(0, total, SHINGLE_BLOCK):
        block = slice(at, at + SHINGLE_BLOCK)
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in zip(starts[block], ends[block])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text: str, out: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint of ``text`` as a long (its 64 bits; null and wordless texts: zero)."""

    @F.arrow_udf("long")
    def column(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64)
        return pa.array(values.view(np.int64))

    return df.withColumn(out, column(utf8(text)))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- the trie walk ----------------------------------------------------------------


class Forest:
    """Which of ``n`` items are linked, as a forest of flat trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.parent[i], self.parent[j]
            apart = i != j
            i, j = i[apart], j[apart]
            self.parent[np.maximum(i, j)] = np.minimum(i, j)  # of several for one root, the last; the rest come again
            while len(i):
                flat = self.parent[self.parent]
                if np.array_equal(flat, self.parent):
                    break
                self.parent = flat


def _ranges(lows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``low .. low + size - 1`` of each range, one range after the other."""
    ends = np.cumsum(sizes)
    found = np.repeat(lows - (ends - sizes), sizes)
    found += np.arange(len(found))
    return found


def trie_links(
    values: np.ndarray, starts: list[tuple[int, int, int, int]], depth: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the values that differ in at most ``budget`` bits.

    ``values``: unsigned, sorted within each node, distinct.  ``starts``: pairs of nodes
    at ``depth``, each node a range of positions: (low, high, low, high).
    """
    first = np.array(starts, np.int64).reshape(-1, 4)
    spent = np.bitwise_count((values[first[:, 0]] ^ values[first[:, 2]]) >> np.uint64(BITS - depth)) if depth else 0
    stack = [(depth, np.column_stack([first, np.broadcast_to(spent, len(first)).astype(np.int64)]))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > CHUNK:
            stack += [(depth, pairs[CHUNK:]), (depth, pairs[:CHUNK])]
            continue
        a, a_end, b, b_end, spent = pairs.T
        many = (a_end - a) * (b_end - b)
        small = (many <= LEAF_PAIRS) | (depth == BITS)
        yield from _compare(values, pairs[small], budget)
        pairs = pairs[~small]
        if not len(pairs):
            continue
        a, a_end, b, b_end, spent = pairs.T
        same = a == b
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        count = ones[depth]
        a_mid, b_mid = a_end - (count[a_end] - count[a]), b_end - (count[b_end] - count[b])
        other = ~same  # of a node with itself, (1, 0) is (0, 1) again
        children = np.concatenate(
            [
                np.column_stack([a, a_mid, b, b_mid, spent]),
                np.column_stack([a_mid, a_end, b_mid, b_end, spent]),
                np.column_stack([a, a_mid, b_mid, b_end, spent + 1]),
                np.column_stack([a_mid, a_end, b, b_mid, spent + 1])[other],
            ]
        )
        kept = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)
        if kept.any():
            stack.append((depth + 1, children[kept]))


def _compare(values: np.ndarray, pairs: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between the nodes of each pair, by comparing all their values."""
    per = np.cumsum((pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]))
    at = 0
    while at < len(pairs):
        to = max(at + 1, int(np.searchsorted(per, (per[at - 1] if at else 0) + CHUNK * 4, "right")))
        a, a_end, b, b_end, _ = pairs[at:to].T
        left = _ranges(a, a_end - a)
        wide = np.repeat(b_end - b, a_end - a)
        right = _ranges(np.repeat(b, a_end - a), wide)
        apart = np.repeat(values[left], wide)
        apart ^= values[right]
        near = np.flatnonzero(np.bitwise_count(apart) <= budget)
        owner = np.searchsorted(np.cumsum(wide), near, "right")
        left, right = left[owner], right[near]
        other = left != right
        yield left[other], right[other]
        at = to


def top_bits(fingerprints: int) -> int:
    """How many levels the shuffle deals out, so that a pair of top nodes holds a bounded number on average."""
    wanted = math.ceil(math.log2(max(1, 2 * fingerprints / PAIR_FINGERPRINTS)))
    return min(max(TOP_BITS, wanted), MOST_TOP_BITS)


def _dealt(distinct: DataFrame, budget: int, bits: int) -> DataFrame:
    """Each row of ``distinct`` at every ``pair`` of top nodes within budget that has its ``fp``."""
    masks = [0]
    for bit in range(bits):
        masks += [m | 1 << bit for m in masks if m.bit_count() < budget]
    top = F.shiftrightunsigned("fp", BITS - bits)

    def pair(mask: Column) -> Column:
        other = top.bitwiseXOR(mask)
        return F.shiftleft(F.least(top, other), bits) + F.greatest(top, other)

    return distinct.select("*", F.explode(F.transform(F.lit(masks).cast("array<bigint>"), pair)).alias("pair"))


def _ends(values: np.ndarray, pair: int, top_bits: int) -> tuple[int, int, int, int]:
    """Where the sorted values of a pair of top nodes begin and end."""
    own = values >> np.uint64(BITS - top_bits)
    (a, a_end), (b, b_end) = (np.searchsorted(own, [x, x + 1]).tolist() for x in divmod(pair, 1 << top_bits))
    return a, a_end, b, b_end


def fingerprint_links(distinct: DataFrame, budget: int = MAX_DIFFERING, bits: int | None = None) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints ``fp`` (long) linked directly or through others."""
    bits = top_bits(distinct.count()) if bits is None else bits

    def walk(key: tuple, group: pa.Table) -> pa.Table:
        values = np.sort(group.column("fp").to_numpy().view(np.uint64))
        a, a_end, b, b_end = _ends(values, key[0].as_py(), bits)
        forest = Forest(len(values))
        if a < a_end and b < b_end:
            waiting, size = [], 0
            for link in trie_links(values, [(a, a_end, b, b_end)], bits, budget):
                waiting.append(link)
                size += len(link[0])
                if size > 4 * CHUNK:
                    forest.link(*map(np.concatenate, zip(*waiting)))
                    waiting, size = [], 0
            if waiting:
                forest.link(*map(np.concatenate, zip(*waiting)))
        linked = np.flatnonzero(forest.parent != np.arange(len(values)))
        signed = values.view(np.int64)
        return pa.table({"a": signed[linked], "b": signed[forest.parent[linked]]})

    return _dealt(distinct.select("fp"), budget, bits).groupBy("pair").applyInArrow(walk, "a long, b long")


# --- components -------------------------------------------------------------------


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is the component's smallest node.

    Alternating stars: each node hands its larger neighbours to its smallest one, then its
    smaller ones.  Each round halves the depth, and ends as stars.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before = None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _with_least(edges: DataFrame) -> DataFrame:
    """Add each node's smallest neighbour; a node with many neighbours is one row on that side of the join."""
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    least = F.least("a", "least")
    return _with_least(both.select("e.*")).where("b > a").select(F.col("b").alias("a"), least.alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # each edge points from the larger node to the smaller; the smallest gets the node and the other neighbours
    moved = F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b"))
    return _with_least(edges).select(moved.alias("a"), F.col("least").alias("b"))


def grouped(prints: DataFrame, budget: int = MAX_DIFFERING) -> DataFrame:
    """(fp, first) of every fingerprint in ``prints`` (fp, rank): the smallest rank reachable."""
    distinct = written(prints.groupBy("fp").agg(F.min("rank").alias("least")), "distinct")
    roots = connected(written(fingerprint_links(distinct.select("fp"), budget), "links"))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = written(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    firsts = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.join(firsts, "root").select("fp", "first")


def near_duplicates(
    df: DataFrame, text: str = "text", id: str = "doc_id", words: int = SHINGLE_WORDS, budget: int = MAX_DIFFERING
) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of ``df``.

    Null and wordless texts have fingerprint zero and link like any other.  Repeated rows
    each get a row.  Rows without an id take part; a group with no id has a null component.
    An empty table gives no rows; other columns do not matter.
    """
    prints = written(with_fingerprints(df.select(F.col(id).alias("doc_id"), text), text, "fp", words).select("doc_id", "fp"), "prints")
    return prints.join(grouped(prints.withColumnRenamed("doc_id", "rank"), budget), "fp").select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def keep_one(
    df: DataFrame, text: str = "text", id: str = "doc_id", words: int = SHINGLE_WORDS, budget: int = MAX_DIFFERING
) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``df``.

    The groups are those of :func:`near_duplicates`.  The row with a group's smallest id stays, or, where
    the group has no id, one of its rows; of rows that repeat an id, one.  Null and wordless texts are
    copies of each other.  An empty table stays empty.
    """
    fp, row = fresh_name(df, "_fp"), fresh_name(df, "_row")
    rows = with_fingerprints(df, text, fp, words).withColumn(row, F.monotonically_increasing_id())
    rows = written(rows, "fingerprinted")
    rank = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), F.col(row).alias("row"))
    firsts = grouped(rows.select(F.col(fp).alias("fp"), rank.alias("rank")), budget)
    kept = written(firsts.select(F.col("first.row").alias(row)).distinct(), "kept")
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
