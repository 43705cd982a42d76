"""STM: each query drains the events table as a stream and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import STREAM_BASELINE, TEST_TENANT
from millrace.catalog.feeds_sql import rounded
from millrace.catalog.registry import query
from millrace.session import scratch_path
from millrace.streaming import monitors
from millrace.streaming.counters import CounterLog, read_counters
from millrace.streaming.runner import BatchSink, counters, run_monitors, start_monitor
from millrace.streaming.sources import decode, stream_source


def payload(events, feed: str):
    """Events as JSON messages of a feed, all fields as text."""
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (
        F.when(F.col("event_type") == "error", "power_outage")
        .when(F.col("event_type") == "signup", "maintenance")
        .otherwise("running")
    )
    fields = {
        "market": {"steel_price_egypt_egp": text("value")},
        "orders": {
            "product_type": F.col("event_type"),
            "quantity_tons": text(F.col("value") * 20),
            "total_value_egp": text(F.col("value") * 1000),
        },
        "production": {
            "facility": F.col("event_type"),
            "production_line": F.concat(F.lit("L"), text(F.col("user_id"))),
            "actual_tons": text("value"),
            "efficiency_pct": text("value"),
            "quality_score": text(k / 10),
            "status": status,
        },
        "shipments": {
            "shipment_id": text("event_id"),
            "origin": F.col("event_type"),
            "destination": text("user_id"),
            "status": status,
            "delay_days": text(k - 50),
        },
    }[feed]
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        text("event_id").alias("event_id"), stamp.alias("event_timestamp"), *[c.alias(n) for n, c in fields.items()]
    )
    return events.select(F.to_json(body).alias("value"))


def live_events(f):
    table = f.table("events")
    return stream_source(f.spark, "parquet", "market", path=f"{f.sf_dir}/events.parquet", schema=table.schema)


def begin(f, feed: str, root: str, **monitor_args):
    sink = BatchSink(f"{root}/{feed}", f"{root}/dead", feed, TEST_TENANT)
    source = payload(live_events(f), feed)
    return start_monitor(source, feed, sink, f"{root}/checkpoint-{feed}", once=True, **monitor_args)


def drained(f, feed: str, **monitor_args):
    root = scratch_path(f.spark, f"stream-{feed}")
    begin(f, feed, root, **monitor_args).awaitTermination()
    return f.spark.read.parquet(f"{root}/{feed}").drop("batch_id", "created_at", "company_id", "factory_id")


_AT = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def at_second(df, col: str):
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd HH:mm:ss"))


_CHANGE = rounded(f"((value - {STREAM_BASELINE}) / {STREAM_BASELINE} * 100)", 2)


@query(
    "stm_01_price_alerts",
    f"""SELECT {_AT} AS alert_time, 'steel_price_egp' AS price_type, value AS current_price,
        CAST({STREAM_BASELINE} AS DOUBLE) AS previous_price, {_CHANGE} AS change_pct,
        CASE WHEN abs({_CHANGE}) > 15 THEN 'CRITICAL' WHEN abs({_CHANGE}) > 10 THEN 'HIGH'
             WHEN abs({_CHANGE}) > 5 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level FROM events""",
)
def _(f):
    return at_second(drained(f, "market", baseline=STREAM_BASELINE), "alert_time")


@query(
    "stm_02_order_summary",
    """SELECT count(*) AS total_orders, round(sum(value * 20), 2) AS total_quantity_tons,
       round(sum(value * 1000), 2) AS total_revenue_egp, count(*) FILTER (value * 20 >= 1000) AS large_orders,
       (SELECT event_type FROM events GROUP BY 1 ORDER BY round(sum(value * 20), 6) DESC, event_type LIMIT 1)
       AS top_product FROM events""",
)
def _(f):
    return drained(f, "orders")


@query(
    "stm_02_order_event_windows",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS total_orders,
       round(sum(value * 20), 2) AS total_quantity_tons, count(*) FILTER (value * 20 >= 1000) AS large_orders
       FROM events GROUP BY 1""",
)
def _(f):
    events = decode(payload(f.table("events"), "orders"), "orders")
    hourly = at_second(monitors.order_windows(events), "window_start")
    return hourly.select("window_start", "total_orders", "total_quantity_tons", "large_orders")


@query(
    "stm_03_production_live",
    f"""SELECT {_AT} AS event_time, event_type AS facility, 'L' || user_id AS production_line, value AS actual_tons,
        value AS efficiency_pct, CAST(k AS DOUBLE) / 10 AS quality_score,
        CASE WHEN event_type = 'error' THEN 'POWER_OUTAGE' WHEN event_type = 'signup' THEN 'MAINTENANCE'
             WHEN value < 70 THEN 'LOW_EFFICIENCY' WHEN k < 70 THEN 'LOW_QUALITY' ELSE 'NORMAL' END AS alert FROM ev""",
)
def _(f):
    return at_second(drained(f, "production"), "event_time")


@query(
    "stm_04_shipment_status",
    f"""SELECT {_AT} AS event_time, CAST(event_id AS VARCHAR) AS shipment_id, event_type AS origin,
        CAST(user_id AS VARCHAR) AS destination, CASE event_type WHEN 'error' THEN 'power_outage'
        WHEN 'signup' THEN 'maintenance' ELSE 'running' END AS status, k - 50 AS delay_days, k > 50 AS is_delayed
        FROM ev""",
)
def _(f):
    return at_second(drained(f, "shipments"), "event_time")


_COUNTED = f"""SELECT 'market' AS feed, count(*) AS events, count(*) FILTER (abs({_CHANGE}) > 10) AS flagged FROM events
        UNION ALL SELECT 'production', count(*), count(*) FILTER (event_type IN ('error', 'signup') OR value < 70 OR k < 70)
        FROM ev UNION ALL SELECT 'shipments', count(*), count(*) FILTER (k > 50) FROM ev"""


@query("stm_05_batch_counters", _COUNTED)
def _(f):
    out = None
    for feed, args in [("market", {"baseline": STREAM_BASELINE}), ("production", {}), ("shipments", {})]:
        rows = monitors.MONITORS[feed](decode(payload(f.table("events"), feed), feed), **args)
        counts = counters(feed)
        flagged = next(n for n in counts if n != "events")
        row = rows.agg(counts["events"].alias("events"), counts[flagged].alias("flagged"))
        row = row.select(F.lit(feed).alias("feed"), "events", "flagged")
        out = row if out is None else out.unionByName(row)
    return out


@query("stm_05_stored_counters", _COUNTED)
def _(f):
    """Counters of drained streams, read back as rows; a second run from the same checkpoints adds none."""
    root = scratch_path(f.spark, "stream-counters")
    log = CounterLog(f.spark, f"{root}/counters")
    f.spark.streams.addListener(log)
    try:
        for _run in range(2):
            for feed, args in [("market", {"baseline": STREAM_BASELINE}), ("production", {}), ("shipments", {})]:
                running = begin(f, feed, root, **args)
                running.awaitTermination()
                log.wait(running)
    finally:
        f.spark.streams.removeListener(log)
    rows = read_counters(f.spark, f"{root}/counters").withColumn("feed", F.regexp_extract("observed", "^(.*)_out$", 1))
    is_total = F.col("counter") == "events"
    return rows.groupBy("feed").agg(
        F.sum(F.when(is_total, F.col("value"))).alias("events"), F.sum(F.when(~is_total, F.col("value"))).alias("flagged")
    )


@query(
    "stm_06_resume_from_checkpoint",
    "SELECT event_type AS origin, count(*) AS n FROM events GROUP BY 1",
)
def _(f):
    """A second run with the same checkpoint finds nothing new and adds nothing."""
    root = scratch_path(f.spark, "stream-resume")
    for _run in range(2):
        begin(f, "shipments", root).awaitTermination()
    return f.spark.read.parquet(f"{root}/shipments").groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_04_stream_source",
    """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, min(event_id) AS first_id FROM events GROUP BY 1""",
)
def _(f):
    root = scratch_path(f.spark, "stream-source")
    writer = live_events(f).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start(f"{root}/rows").awaitTermination()
    back = f.spark.read.parquet(f"{root}/rows")
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.min("event_id").alias("first_id")
    )


@query(
    "stm_07_all_streams",
    """SELECT 'market' AS feed, count(*) AS n FROM events UNION ALL SELECT 'orders', 1 UNION ALL
       SELECT 'production', count(*) FROM events UNION ALL SELECT 'shipments', count(*) FROM events""",
)
def _(f):
    root = scratch_path(f.spark, "streams")
    running = [begin(f, feed, root) for feed in ("market", "orders", "production", "shipments")]
    for q in running:
        q.awaitTermination()
    run_monitors(f.spark, running, timeout=1)
    out = None
    for feed in ("market", "orders", "production", "shipments"):
        row = f.spark.read.parquet(f"{root}/{feed}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(feed).alias("feed"), "n")
        out = row if out is None else out.unionByName(row)
    return out
