"""What a stream's peeks have seen, kept as a table.

``sinks.peek`` makes Spark observe the rows that pass; a listener gets the numbers after each micro-batch and
puts them down as a record named by the run and the batch.  So they can be queried while the job
runs and after it, and a batch that is run again replaces its record.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from topicflow import files


class PeekRecorder(StreamingQueryListener):
    """Puts the observed metrics of every query in the session that has the peek ``name`` into ``path``.

    Use it as a context: it listens from its beginning to its end.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> "PeekRecorder":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None or not progress.numInputRows:
            return
        record = {"query_id": str(progress.id), "batch_id": progress.batchId, "name": self.name, "metrics": json.dumps(seen.asDict(), default=str)}
        files.write_record(self.spark, f"{self.path}/{progress.id}-{progress.batchId:019d}.json", record)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all of its events have been met; they come in their order, some time later."""
        query.awaitTermination()
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError("the query's last event has not come")


def peeked(spark: SparkSession, path: str, metrics: str) -> DataFrame:
    """What has been recorded in ``path``: (query_id, batch_id, name) and the ``metrics``, a struct's fields as in DDL."""
    rows = spark.read.schema("query_id string, batch_id bigint, name string, metrics string").json(path)
    return rows.select("query_id", "batch_id", "name", F.inline(F.array(F.from_json("metrics", metrics))))
