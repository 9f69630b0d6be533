"""A keyed table that grows batch by batch and costs what its live rows cost.

The rows of a key lie in one bucket, by the key's hash.  A batch writes the rows of its own keys, one
folder per bucket (a change); of the other buckets nothing is read or written.  A bucket with more than
``compact_every`` changes is combined into one row per key (its base).  Which base and changes make up each
bucket is written down in one record per batch, the manifest, and that alone makes a batch's work count:

* a batch that fails before its manifest has left files that no manifest names;
* a batch that is run again starts from the manifest before it and writes to new folders, so it finds
  what it found the first time, and readers of the table see the one or the other, never a mixture;
* folders that the last ``RETAIN`` manifests do not name are deleted, so neither the
  number of files nor the cost of a read grows with the number of batches.

One writer at a time, as a streaming query is.  A reader that holds an old manifest for longer
than ``RETAIN`` batches may meet deleted files and reads again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topicflow import files

#: Changes of a bucket that are read beside its base.
COMPACT_EVERY = 8
#: Manifests kept: the last one and the one that a batch run again starts from.
RETAIN = 2
BUCKET = "key_bucket"


class KeyedTable:
    """A table of one row per key in the folder ``path``.

    ``schema``: the keys and the column ``state``.  ``combine`` makes one state of several, whatever their
    sequence (``F.sum``, ``F.max``).  ``buckets``: parts of the keys, as many as there are shuffle partitions unless
    given; as with Spark's own state, the first batch fixes it, so choose it for the size the table will have.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        keys: Sequence[str],
        combine: Callable[[Column], Column],
        buckets: int | None = None,
        compact_every: int = COMPACT_EVERY,
    ):
        self.spark, self.path, self.keys, self.combine = spark, path, list(keys), combine
        self.schema = spark.createDataFrame([], schema).schema
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.compact_every = compact_every

    # --- manifests ----------------------------------------------------------------

    def _record(self, batch_id: int) -> str:
        return f"{self.path}/manifest/{batch_id:019d}.json"

    def batches(self) -> list[int]:
        """The batches whose manifests are kept."""
        return [int(name.removesuffix(".json")) for name in files.names(self.spark, f"{self.path}/manifest")]

    def manifest(self, batch_id: int | None = None) -> dict:
        """Buckets and their folders as of the batch, or as of the last one."""
        known = [b for b in self.batches() if batch_id is None or b <= batch_id]
        if not known:
            return {"buckets": self.buckets, "folders": {}}
        return files.read_record(self.spark, self._record(max(known)))

    # --- reading ------------------------------------------------------------------

    def _rows(self, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/{folder}" for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _combined(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(self.combine(F.col("state")).alias("state")).select(*self.schema.fieldNames())

    def read(self, batch_id: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table as the batch (or the last one) has left it, whole or of the given buckets."""
        folders = self.manifest(batch_id)["folders"]
        chosen = folders if buckets is None else [str(b) for b in buckets if str(b) in folders]
        return self._combined(self._rows(folder for b in chosen for folder in folders[b]))

    def of_keys(self, keys: DataFrame, batch_id: int | None = None) -> DataFrame:
        """The rows of the given keys, from their buckets alone."""
        found = keys.select(self._bucket(self.manifest(batch_id)["buckets"]).alias(BUCKET)).distinct().collect()
        rows = self.read(batch_id, [r[0] for r in found])
        return rows.join(keys.select(*self.keys), self.keys, "left_semi")

    # --- writing ------------------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _put(self, rows: DataFrame, kind: str, batch_id: int, buckets: int) -> dict[str, str]:
        """Write rows into new folders and return these by bucket; the buckets are what the folders are named."""
        folder = f"{kind}/{batch_id:019d}-{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, self._bucket(buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        found = files.names(self.spark, f"{self.path}/{folder}")
        return {name.split("=")[1]: f"{folder}/{name}" for name in found if name.startswith(f"{BUCKET}=")}

    def put(self, change: DataFrame, batch_id: int) -> dict[str, str]:
        """Add the rows of a batch, several to a key if need be, and return their folders by bucket."""
        earlier = self.manifest(batch_id - 1)
        buckets, folders = earlier["buckets"], earlier["folders"]
        own = self._put(change, "change", batch_id, buckets)
        now = folders | {b: [*folders.get(b, []), folder] for b, folder in own.items()}
        full = [b for b in own if len(now[b]) > self.compact_every]
        if full:
            whole = self._put(self._combined(self._rows(f for b in full for f in now[b])), "base", batch_id, buckets)
            now |= {b: [folder] for b, folder in whole.items()}
        files.write_record(self.spark, self._record(batch_id), {"buckets": buckets, "folders": now})
        self._retire(batch_id, own.values())
        return own

    def take(self, change: DataFrame, batch_id: int) -> DataFrame | None:
        """Add the rows of a batch and return what its keys had before; ``None`` if no batch came before.

        What is returned reads only the buckets that the batch touches.
        """
        folders = self.manifest(batch_id - 1)["folders"]
        own = self.put(change, batch_id)
        if not folders:
            return None
        known = self._rows(folder for b in own if b in folders for folder in folders[b])
        return self._combined(known.join(self._rows(own.values()).select(*self.keys), self.keys, "left_semi"))

    def _retire(self, batch_id: int, own: Iterable[str]) -> None:
        """Delete what no kept manifest names, but for the rows the batch has just brought, which its caller may read.

        Manifests of later batches go as well: their work is about to be done again.
        """
        known = self.batches()
        kept = sorted(b for b in known if b <= batch_id)[-RETAIN:]
        named = set(own)
        for b in kept:
            found = files.read_record(self.spark, self._record(b))["folders"]
            named |= {folder for own in found.values() for folder in own}
        for b in set(known) - set(kept):
            files.remove(self.spark, self._record(b))
        for kind in ("change", "base"):
            for name in files.names(self.spark, f"{self.path}/{kind}"):
                parts = files.names(self.spark, f"{self.path}/{kind}/{name}")
                live = [p for p in parts if f"{kind}/{name}/{p}" in named]
                if not live:
                    files.remove(self.spark, f"{self.path}/{kind}/{name}")
                else:
                    for p in set(parts) - set(live):
                        files.remove(self.spark, f"{self.path}/{kind}/{name}/{p}")
