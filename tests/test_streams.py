"""Monitors on broken messages, batches and replays; stream results equal batch results."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.streaming import monitors
from millrace.streaming.runner import BatchSink, counters, run_monitors, start_monitor
from millrace.streaming.sources import decode, kafka_options, stream_source
from millrace.tenancy import Tenant

TENANT = Tenant("A", "A1")


@pytest.fixture
def messages(tmp_path):
    """JSON lines of a feed in a folder of their own."""

    def write(*records):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        name = f"{len(list(folder.iterdir()))}.txt"
        (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
        # The file source goes by modification time; two files of one millisecond have no order.
        age = 1_700_000_000 + len(list(folder.iterdir()))
        os.utime(folder / name, (age, age))
        return str(folder)

    return write


def run(spark, feed, folder, tmp_path, write=None, **args):
    sink = BatchSink(str(tmp_path / "out"), str(tmp_path / "dead"), feed, TENANT, write=write)
    source = stream_source(spark, "text", feed, path=folder, files_per_trigger=1)
    query = start_monitor(source, feed, sink, str(tmp_path / "checkpoint"), once=True, **args)
    query.awaitTermination()
    return query


MARKET = [
    {"event_id": "1", "event_timestamp": "2024-01-01T10:00:00", "steel_price_egypt_egp": "42000"},
    {"event_id": "2", "event_timestamp": "2024-01-01T10:00:01", "steel_price_egypt_egp": "44500"},
    {"event_id": "3", "event_timestamp": "bad", "steel_price_egypt_egp": "47000"},
    {"event_id": "4", "steel_price_egypt_egp": "abc"},
    {"event_id": "5", "steel_price_egypt_egp": "30000"},
    '{"event_id": "6", ',
]


def test_market_stream(spark, messages, tmp_path):
    query = run(spark, "market", messages(*MARKET), tmp_path)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("current_price").collect()
    assert [r.alert_level for r in got if r.current_price] == ["CRITICAL", "LOW", "MEDIUM", "HIGH"]
    assert [r.alert_level for r in got if r.current_price is None] == ["LOW", "LOW"]
    assert {(r.company_id, r.factory_id) for r in got} == {("A", "A1")}
    assert sum(r.alert_time is not None for r in got) == 2
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert progress[-1].observedMetrics["market_out"].events == 6


def test_stream_equals_batch(spark, messages, tmp_path):
    folder = messages(*MARKET)
    run(spark, "market", folder, tmp_path, baseline=45000.0)
    streamed = spark.read.parquet(str(tmp_path / "out")).drop("batch_id", "created_at", "company_id", "factory_id")
    batch = monitors.price_alerts(decode(spark.read.text(folder), "market"), baseline=45000.0)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_order_summary_per_batch(spark, messages, tmp_path):
    messages({"product_type": "a", "quantity_tons": "1000", "total_value_egp": "1"}, {"product_type": "b", "quantity_tons": "10"})
    folder = messages({"product_type": "b", "quantity_tons": "x"})
    run(spark, "orders", folder, tmp_path)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("batch_id").collect()
    assert [(r.total_orders, r.total_quantity_tons, r.large_orders, r.top_product) for r in got] == [
        (2, 1010.0, 1, "a"), (1, None, 0, "b"),
    ]


def test_empty_summary(spark):
    empty = decode(spark.createDataFrame([], "value string"), "orders")
    row = monitors.order_summary(empty).first()
    assert (row.total_orders, row.large_orders, row.top_product) == (0, 0, "unknown")


def test_failed_batch_goes_to_the_dead_letter(spark, messages, tmp_path):
    def refuse(_df, _id):
        raise OSError("no space")

    run(spark, "shipments", messages({"shipment_id": "s1", "delay_days": "2"}, {"shipment_id": "s2"}), tmp_path, write=refuse)
    dead = spark.read.json(str(tmp_path / "dead")).collect()
    assert sorted(json.loads(r.record)["shipment_id"] for r in dead) == ["s1", "s2"]
    assert {r.error for r in dead} == {"no space"}


def test_replayed_batch_does_not_duplicate(spark, tmp_path):
    sink = BatchSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT)
    for batch_id in (0, 0, 1):
        sink(spark.range(3), batch_id)
    sink(spark.range(0), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


@pytest.mark.parametrize(
    "status, eff, quality, alert",
    [
        ("power_outage", 10.0, 1.0, "POWER_OUTAGE"), ("maintenance", 10.0, 1.0, "MAINTENANCE"),
        ("running", 69.9, 1.0, "LOW_EFFICIENCY"), ("running", 70.0, 6.9, "LOW_QUALITY"),
        ("running", 70.0, 7.0, "NORMAL"), (None, None, None, "NORMAL"),
    ],
)
def test_production_alert(rows, status, eff, quality, alert):
    df = rows([(status, eff, quality)], "s string, e double, q double")
    assert df.select(monitors.production_alert("s", "e", "q")).first()[0] == alert


def test_bad_json_is_kept_on_request(spark):
    df = spark.createDataFrame([('{"shipment_id": ',), ('{"shipment_id": "s"}',)], "value string")
    got = decode(df, "shipments", keep_bad=True).select("shipment_id", F.col("_corrupt_record").isNotNull().alias("bad")).collect()
    assert [tuple(r) for r in got] == [(None, True), ("s", False)]


def test_event_time_windows_on_a_stream(spark, messages, tmp_path):
    folder = messages(
        *[{"event_timestamp": f"2024-01-01T{h:02d}:15:00", "quantity_tons": "1"} for h in (1, 1, 2, 5)]
    )
    out = monitors.order_windows(decode(stream_source(spark, "text", "orders", path=folder), "orders"))
    query = out.writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    closed = spark.table("windows").orderBy("window_start").collect()
    assert [r.total_orders for r in closed] == [2, 1]  # the last hour is still open


def test_run_monitors_stops_everything(spark, messages, tmp_path):
    folder = messages(*MARKET)
    sink = BatchSink(str(tmp_path / "out"), str(tmp_path / "dead"), "market", TENANT)
    source = stream_source(spark, "text", "market", path=folder)
    query = start_monitor(source, "market", sink, str(tmp_path / "c"))
    query.processAllAvailable()
    report = run_monitors(spark, [query], timeout=1)
    assert report[0]["name"] == "market_alerts" and not query.isActive


def test_kafka_options():
    options = kafka_options("orders", "broker:1")
    assert options["subscribe"] == "steel_orders" and "maxOffsetsPerTrigger" not in options
    assert kafka_options("orders", "broker:1", 500)["maxOffsetsPerTrigger"] == "500"
    assert set(counters("orders")) == {"events"}


def test_stored_counters(spark, messages, tmp_path):
    from millrace.streaming.counters import CounterLog, read_counters

    path = str(tmp_path / "counters")
    log = CounterLog(spark, path)
    spark.streams.addListener(log)
    try:
        messages(*MARKET[:2])
        folder = messages(*MARKET[2:])
        for _ in range(2):  # the second run finds nothing new
            log.wait(run(spark, "market", folder, tmp_path))
        got = {(r.batch_id, r.counter): r.value for r in read_counters(spark, path).collect()}
        assert got == {(0, "events"): 2, (0, "high_alerts"): 0, (1, "events"): 4, (1, "high_alerts"): 2}
        # A replay of a batch takes the place of its counters; a folder that cannot be written is reported.
        log._store(f"{path}/query_id=x", 0, '{"counter": "events", "value": 1}')
        log._store(f"{path}/query_id=x", 0, '{"counter": "events", "value": 2}')
        assert [r.value for r in read_counters(spark, path).filter("query_id = 'x'").collect()] == [2]
        log.path = "nosuchscheme://x/y"
        messages(*MARKET)
        with pytest.raises(Exception):
            log.wait(run(spark, "market", folder, tmp_path))
    finally:
        spark.streams.removeListener(log)
