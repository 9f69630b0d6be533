"""Bounded reads that remember how far they got.

A read is done in three steps: an intent record says which offsets of which partitions it covers, the rows are
handled, and a commit record says that this is done.  A reader that stops in between
finds the intent when it starts again and reads the very same offsets, however much has arrived since.
If handling a read replaces what an earlier attempt at the same number left (a folder named by the number,
say), every record counts exactly once.

Records are small files in the shared folder that appear whole or not at all; each holds one number per
partition.  One reader at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicflow import files
from topicflow.sources.topics import EARLIEST

Offsets = dict[str, dict[str, int]]
RANGES = "topic string, partition int, _first bigint, _end bigint"


@dataclass(frozen=True)
class Read:
    """Offsets from ``first`` up to, without, ``end`` of each partition; those without ``first`` from their beginning."""

    number: int
    first: Offsets
    end: Offsets

    def of(self, rows: DataFrame) -> DataFrame:
        """The records of a topic table that this read covers."""
        spark = rows.sparkSession
        ranges = [
            (topic, int(p), self.first.get(topic, {}).get(p), end)
            for topic, ends in self.end.items()
            for p, end in ends.items()
            if end != self.first.get(topic, {}).get(p)
        ]
        # one row per partition of the topic, so Spark broadcasts it by its size
        joined = rows.join(spark.createDataFrame(ranges, RANGES), ["topic", "partition"])
        within = (F.col("offset") < F.col("_end")) & (F.col("_first").isNull() | (F.col("offset") >= F.col("_first")))
        return joined.where(within).select(*rows.columns)

    def kafka_options(self) -> dict[str, str]:
        """The same range as options of a bounded Kafka read."""
        first = {t: {p: self.first.get(t, {}).get(p, EARLIEST) for p in ends} for t, ends in self.end.items()}
        return {
            "startingOffsets": json.dumps(first, sort_keys=True),
            "endingOffsets": json.dumps(self.end, sort_keys=True),
        }


class ReadLog:
    """The intents and commits of a reader, in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _record(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number:019d}.json"

    def _numbers(self, kind: str) -> list[int]:
        return [int(name.removesuffix(".json")) for name in files.names(self.spark, f"{self.path}/{kind}")]

    def committed(self) -> tuple[int, Offsets]:
        """The number of the last read that is done and the next offset of each partition; (-1, {}) before the first."""
        done = max(self._numbers("commit"), default=-1)
        return (done, files.read_record(self.spark, self._record("commit", done))) if done >= 0 else (-1, {})

    def progress(self) -> DataFrame:
        """The committed progress as (topic, partition, next_offset)."""
        _, offsets = self.committed()
        rows = [(topic, int(p), n) for topic, ends in offsets.items() for p, n in ends.items()]
        return self.spark.createDataFrame(rows, "topic string, partition int, next_offset bigint")

    def begin(self, rows: DataFrame, limit: int | None = None) -> Read | None:
        """The read to do now: one that was begun and not committed, else what is new; ``None`` if nothing is.

        ``limit`` bounds the offsets taken from one partition.
        """
        done, first = self.committed()
        intent = files.read_record(self.spark, self._record("intent", done + 1))
        if intent is None:
            intent = {topic: dict(ends) for topic, ends in first.items()}
            fresh = rows.groupBy("topic", "partition").agg(F.min("offset").alias("least"), (F.max("offset") + 1).alias("next"))
            for topic, p, least, end in fresh.select("topic", "partition", "least", "next").toLocalIterator():
                start = first.get(topic, {}).get(str(p), least)
                if end > start:
                    intent.setdefault(topic, {})[str(p)] = min(end, start + limit) if limit else end
            if intent == first:
                return None
            files.write_record(self.spark, self._record("intent", done + 1), intent)
        return Read(done + 1, first, intent)

    def commit(self, read: Read) -> None:
        """Record that a read is done.  Records of reads before it are deleted."""
        files.write_record(self.spark, self._record("commit", read.number), read.end)
        for kind in ("intent", "commit"):
            for number in self._numbers(kind):
                if number < read.number:
                    files.remove(self.spark, self._record(kind, number))

    def drain(
        self, rows: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], limit: int | None = None
    ) -> int:
        """Read, handle and commit until a read finds nothing; returns the number of reads.

        ``handle`` gets the records and the number of the read, and must replace what an earlier attempt at
        that number has left.
        """
        done = 0
        while True:
            topic = rows()
            read = self.begin(topic, limit)
            if read is None:
                return done
            handle(read.of(topic), read.number)
            self.commit(read)
            done += 1
