"""Counters of running streams as rows (STM-05).

``CounterLog`` listens to the progress of a session's streams and writes the observed counters of each batch to a file
of its own, named by query and batch. A replayed batch overwrites its file, so no batch counts twice; a checkpoint
that starts anew has a new query id and collides with nothing. Listeners run behind the batch: counters of a batch whose
driver died before it reported are missing until the batch is replayed.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.sinks.tables import _fs

ROWS = "name string, run_id string, at string, input_rows long, observed string, counter string, value long"


class CounterLog(StreamingQueryListener):
    """Add with ``spark.streams.addListener``; ``path`` is a folder on storage that all readers share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._errors: list[Exception] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        base = {"name": progress.name, "run_id": str(progress.runId), "at": progress.timestamp, "input_rows": progress.numInputRows}
        rows = [
            {**base, "observed": observed, "counter": counter, "value": value}
            for observed, row in progress.observedMetrics.items()
            for counter, value in row.asDict().items()
        ]
        try:
            self._store(f"{self.path}/query_id={progress.id}", progress.batchId, "\n".join(map(json.dumps, rows)))
        except Exception as error:  # raised to the caller by ``wait``: an exception here would only be logged
            self._errors.append(error)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def _store(self, folder: str, batch: int, text: str) -> None:
        # Written beside and renamed, so a reader never meets half a file.
        fs, beside = _fs(self.spark, f"{folder}/_{batch:020d}")
        out = fs.create(beside, True)
        out.write(text.encode())
        out.close()
        _, target = _fs(self.spark, f"{folder}/{batch:020d}.json")
        fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"{target} could not be written")

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until an ended stream's last counters are stored; raises what went wrong in storing."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"no end of {query.name} was reported")
        if self._errors:
            raise self._errors[0]


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, batch and counter."""
    rows = spark.read.schema(f"{ROWS}, query_id string").json(path)
    batch = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("long")
    return rows.select("query_id", batch.alias("batch_id"), *[c for c in rows.columns if c != "query_id"])
