"""Progress of running streams, landed as rows: one for each micro-batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from playlens.sources import storage

PROGRESS = "query STRING, run STRING, batch BIGINT, at STRING, input_rows BIGINT, millis BIGINT, metrics MAP<STRING, MAP<STRING, STRING>>"


class ProgressLog(StreamingQueryListener):
    """Writes a small file below ``path`` for each micro-batch of the streams of a session, with their observed metrics.

    A run's micro-batch has one file, whatever how often it is told of. Events come a little after the
    micro-batch; ``wait`` returns when the end of a run has been told.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: dict[str, threading.Event] = {}
        storage.make_folder(spark, self.path)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        now = event.progress
        metrics = {name: {key: str(value) for key, value in row.asDict().items()} for name, row in now.observedMetrics.items()}
        row = {"query": now.name, "run": str(now.runId), "batch": now.batchId, "at": now.timestamp,
               "input_rows": now.numInputRows, "millis": now.batchDuration, "metrics": metrics}
        try:
            storage.write_text(self.spark, f"{self.path}/{now.runId}-{now.batchId}.json", json.dumps(row, ensure_ascii=False) + "\n")
        except FileExistsError:
            pass  # an idle trigger tells of the last micro-batch again

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60) -> None:
        if not self._end(run).wait(seconds):
            raise TimeoutError(f"the end of run {run} was not told within {seconds} s")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path)
