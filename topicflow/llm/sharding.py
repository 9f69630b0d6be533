"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Documents with equal texts stay together, so what is dealt out are groups.  Differencing
starts with each item as a partial partition of its own: the item in one shard, nothing
in the others.  Again and again the two partial partitions with the largest spread are
combined, the fullest shard of one with the emptiest of the other, until one is left.

Differencing is a sequence of steps, so it gets a bounded number of items.  Groups that
hold more than 1/``ATOMS`` of all bytes, of which there can be no more than ``ATOMS``, are
items of their own, and the others are bundled by a hash of their text into ``ATOMS``
items.  The spread that is left is about that of the last bundles combined, a tiny share
of a shard however many documents there are; only a single group larger than a shard can
make it more.  Everything that grows with the data (sizes, groups, assignment, slots) is
aggregated and joined by Spark.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window, functions as F

from topicflow.llm.common import utf8, written

SHARDS = 16
#: Items that differencing is given: at most twice as many.
ATOMS = 1 << 14
#: Rows that are numbered together; a shard has as many such buckets as it needs.
BUCKET_ROWS = 1 << 16
MIN_BUCKETS = 8


def differencing(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item; shards come out ordered from the fullest."""
    if not sizes:
        return []
    items = len(sizes)
    heap = [(-size, i, (size, *[0] * (shards - 1))) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made: list[tuple[int, int, list[int]]] = []  # what each combination was made of
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(shards), key=sums.__getitem__, reverse=True)
        least = sums[order[-1]]
        new = tuple(sums[k] - least for k in order)
        made.append((i, j, order))
        heapq.heappush(heap, (-new[0], items + len(made) - 1, new))
    found = [0] * items
    place = {heap[0][1]: list(range(shards))}
    for node in range(items + len(made) - 1, -1, -1):  # parts are numbered below what they make
        where = place.pop(node)
        if node < items:
            found[node] = where[0]
            continue
        i, j, order = made[node - items]
        own = [0] * shards
        for at, k in enumerate(order):
            own[k] = where[at]
        place[i], place[j] = own, own[::-1]
    return found


def shard_documents(
    df: DataFrame, text: str = "text", id: str = "doc_id", shards: int = SHARDS, atoms: int = ATOMS
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each row of ``df``.

    ``size``: bytes of the text and one more.  A null text counts as the empty one.  Slots
    number a shard's rows from 0 without gaps; among equal rows any order will do.  An
    empty table gives no rows.
    """
    bytes_ = utf8(text)
    rows = df.select(
        F.col(id).alias("doc_id"),
        (F.length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.md5(bytes_).alias("key"),
    )
    rows = written(rows.withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(atoms))), "sizes")
    groups = written(rows.groupBy("key", "bundle").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    total, count = groups.agg(F.sum("bytes"), F.sum("n")).first()
    total, count = int(total or 0), int(count or 0)

    large = groups.where(F.col("bytes") * F.lit(atoms).cast("decimal(20,0)") > F.lit(total).cast("decimal(38,0)"))
    rest = groups.where(F.col("bytes") * F.lit(atoms).cast("decimal(20,0)") <= F.lit(total).cast("decimal(38,0)"))
    # at most ``atoms`` rows each
    keys = sorted((r["key"], r["bytes"]) for r in large.select("key", "bytes").collect())
    bundles = sorted((r["bundle"], r["bytes"]) for r in rest.groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect())
    found = differencing([b for _, b in keys] + [b for _, b in bundles], shards)
    spark = df.sparkSession
    by_key = spark.createDataFrame([(k, s) for (k, _), s in zip(keys, found)], "key string, own int")
    by_bundle = spark.createDataFrame([(b, s) for (b, _), s in zip(bundles, found[len(keys) :])], "bundle long, bundled int")

    placed = rows.join(F.broadcast(by_key), "key", "left").join(F.broadcast(by_bundle), "bundle", "left")
    buckets = max(MIN_BUCKETS, math.ceil(count / (shards * BUCKET_ROWS)))
    placed = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.coalesce("own", "bundled").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).alias("bucket"),
    )
    in_bucket = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))  # a row for each bucket
    firsts = firsts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.withColumn("place", in_bucket).join(firsts, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, rows_per_file: int = 1 << 20) -> None:
    """Write rows that have a ``shard`` and a ``slot`` as a folder for each shard, in slot order."""
    parts = df.repartition("shard", F.floor(F.col("slot") / rows_per_file))
    parts.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
