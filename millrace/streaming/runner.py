"""Sinks and the life cycle of the streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.dates import stamp
from millrace.schemas import STREAM_SETTINGS
from millrace.sinks.tables import dead_letter
from millrace.streaming.monitors import MONITORS, PER_BATCH
from millrace.streaming.sources import decode
from millrace.tenancy import Tenant, tag

def counters(feed: str) -> dict:
    """Counters of a monitor's output, to be observed on the running query (STM-05)."""
    conditions = {
        "market": {"high_alerts": lambda: F.col("alert_level").isin("HIGH", "CRITICAL")},
        "orders": {},
        "production": {"issues": lambda: F.col("alert") != "NORMAL"},
        "shipments": {"delayed": lambda: F.col("is_delayed")},
    }[feed]
    return {"events": F.count(F.lit(1)), **{n: F.count_if(make()) for n, make in conditions.items()}}


@dataclass(frozen=True)
class BatchSink:
    """Writes each micro-batch once (SNK-09).

    Every batch has a folder named by its id: a replayed batch overwrites its own folder, so the
    result is exactly-once. A batch that cannot be written goes to the dead letter whole.
    """

    path: str
    dead_letter_path: str
    table: str
    tenant: Tenant
    write: Callable[[DataFrame, int], None] | None = None

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        rows = stamp(tag(df, self.tenant.company_id, self.tenant.factory_id, keep_existing=True), "created_at")
        rows = rows.persist()  # the check, the write and a possible dead letter read the batch once
        try:
            if not rows.isEmpty():
                self._store(rows, batch_id)
        finally:
            rows.unpersist()

    def _store(self, rows: DataFrame, batch_id: int) -> None:
        try:
            if self.write is not None:
                self.write(rows, batch_id)
            else:
                rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        except Exception as error:  # the stream goes on; nothing is lost
            dead_letter(rows, self.dead_letter_path, self.table, error)


def start_monitor(
    source: DataFrame, feed: str, sink: BatchSink, checkpoint: str, *, once: bool = False, **monitor_args
) -> StreamingQuery:
    """Decode, monitor and write one feed (STM-01..06).

    Stateless monitors are part of the streaming plan; the order summary, which is per micro-batch,
    runs inside the batch. ``once`` drains what is available and stops.
    """
    monitor = MONITORS[feed]
    events = decode(source, feed)
    if feed in PER_BATCH:
        out = events.observe(f"{feed}_in", F.count(F.lit(1)).alias("events"))

        def handle(df: DataFrame, batch_id: int) -> None:
            sink(monitor(df, **monitor_args).filter("total_orders > 0"), batch_id)
    else:
        out = monitor(events, **monitor_args)
        out = out.observe(f"{feed}_out", *[c.alias(n) for n, c in counters(feed).items()])
        handle = sink
    settings = STREAM_SETTINGS[feed]
    writer = out.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).queryName(settings["query"])
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=settings["trigger"])
    return writer.start()


def run_monitors(spark: SparkSession, queries: list[StreamingQuery], timeout: int = 300) -> list[dict]:
    """Wait for the streams, report their status and stop all of them (STM-07)."""
    try:
        spark.streams.awaitAnyTermination(timeout)
    finally:
        report = []
        for q in queries:
            status = q.status
            report.append(
                {
                    "name": q.name,
                    "isDataAvailable": status.get("isDataAvailable"),
                    "isTriggerActive": status.get("isTriggerActive"),
                    "lastProgress": q.lastProgress,
                }
            )
            q.stop()
    return report
