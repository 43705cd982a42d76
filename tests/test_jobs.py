"""The layered jobs end to end on feeds written as CSV from the test tables."""

import pytest
from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_REGIONS, Feeds
from millrace.operators import marts
from millrace.plans import jobs
from millrace.sources.tables import MissingLayer, read_layer
from millrace.tenancy import Tenant


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    feeds = Feeds(spark, sf_dir)
    frames = {
        "market": feeds.market, "production": feeds.production, "orders": feeds.orders,
        "shipments": feeds.shipments, "raw_materials": feeds.purchases,
    }
    files = {}
    for name, df in frames.items():
        files[name] = str(root / "csv" / name)
        for flag in ("is_ramadan", "is_delayed", "on_time"):
            if flag in df.columns:
                df = df.withColumn(flag, F.col(flag).cast("boolean"))
        df.write.option("header", True).csv(files[name])
    lake = jobs.Lake(str(root / "lake"), regions=TEST_REGIONS)
    jobs.run_all(spark, lake, files)
    return lake, feeds


def mart(spark, lake, name):
    return read_layer(spark, f"{lake.root}/marts", name, "marts")


def test_marts_equal_the_direct_result(spark, lake):
    lake, feeds = lake
    cols = ["company_id", "factory_id", "date", "total_orders", "total_production_tons", "total_shipments"]
    stored = mart(spark, lake, "daily_kpis").select(*cols)
    direct = feeds.daily_kpis.select(*cols)
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()
    assert mart(spark, lake, "regional_demand").count() == feeds.regional_demand.count()
    assert mart(spark, lake, "price_features").count() == feeds.market.count()
    assert mart(spark, lake, "supplier_scorecard").count() == feeds.supplier_scorecard.count()


def test_repair_reached_the_line_mart(spark, lake):
    lake, _feeds = lake
    clean = read_layer(spark, f"{lake.root}/clean", "production_clean", "cleaning")
    assert clean.filter("efficiency_pct > 100").isEmpty()
    assert mart(spark, lake, "production_efficiency").filter("avg_efficiency > 100").isEmpty()


def test_alerts_of_a_run(spark, lake):
    lake, feeds = lake
    low = read_layer(spark, f"{lake.root}/clean", "production_clean", "cleaning").filter("is_underperforming = 1")
    tenants = low.select("company_id", "factory_id").distinct()
    told = [(r.company_id, r.factory_id, True, "own@x") for r in tenants.limit(1).collect()] + [("NEW", "NEW_1", True, "new@x")]
    subscriptions = spark.createDataFrame(told, "company_id string, factory_id string, enabled boolean, notify_email string")
    wired = jobs.Lake(lake.root, regions=TEST_REGIONS, subscriptions=subscriptions)
    for _ in range(2):  # a second run replaces the first one's
        jobs.write_alerts(spark, wired)
    alerts = spark.read.parquet(f"{lake.root}/alerts")
    spikes = read_layer(spark, f"{lake.root}/clean", "market_clean", "cleaning").filter("is_price_spike = 1").count()
    assert alerts.filter("event_type = 'low_efficiency'").count() == tenants.count()
    market = alerts.filter("event_type = 'price_spike'").collect()
    assert {(r.factory_id, r.row_count, r.channel, r.notify_email) for r in market} == {(t[1], spikes, "market", t[3]) for t in told}
    events = spark.read.parquet(f"{lake.root}/alert_events").groupBy("event_type").count().collect()
    assert {r.event_type: r["count"] for r in events} == {"low_efficiency": low.count(), "price_spike": spikes}


def test_upload_reaches_the_raw_layer(spark, lake, tmp_path):
    from millrace.schemas import FEED_KEYS, UPLOAD_REQUIRED

    other, feed = jobs.Lake(str(tmp_path / "lake")), "shipments"
    cols = dict.fromkeys([*UPLOAD_REQUIRED[feed], *FEED_KEYS[feed], "transport_mode"])
    file = lake[1].shipments.select(*cols).limit(5)
    factories = spark.createDataFrame([("A", "A1"), ("B", "B1")], "company_id string, factory_id string")
    first = jobs.load_upload(spark, other, file, feed, Tenant("A", "A1"), factories).count()
    again = jobs.load_upload(spark, other, file, feed, Tenant("A", "A1"), factories).count()
    jobs.load_upload(spark, other, file, feed, Tenant("B", "B1"), factories)
    raw = read_layer(spark, f"{other.root}/raw", feed, "raw")
    assert again == 0 and first > 0 and {r.factory_id: r["count"] for r in raw.groupBy("factory_id").count().collect()} == {"A1": first, "B1": first}


def test_mirror_and_audit(spark, lake):
    lake, _feeds = lake
    seen = {}
    jobs.mirror_marts(spark, lake, lambda name, df: seen.update({name: df.count()}))
    assert seen.keys() == set(jobs.MARTS) and all(seen.values())
    audit = jobs.repair_clean(spark, lake).first()
    assert audit.rows_before == audit.rows_after and audit.bad_before == audit.bad_after and audit.removed_rows == 0


def test_tenant_run_leaves_the_others(spark, lake):
    lake, _feeds = lake
    before = mart(spark, lake, "regional_demand").groupBy("company_id").count().collect()
    scoped = jobs.Lake(lake.root, Tenant("ASIA", "ASIA_0"), regions=TEST_REGIONS)
    jobs.build_marts(spark, scoped)
    after = mart(spark, lake, "regional_demand").groupBy("company_id").count().collect()
    assert {r.company_id: r["count"] for r in before} == {r.company_id: r["count"] for r in after}
    keys = marts.SCORECARD_KEYS
    assert mart(spark, lake, "supplier_scorecard").groupBy(*keys).count().filter("count > 1").isEmpty()


def test_marts_need_the_cleaned_layer(spark, tmp_path):
    with pytest.raises(MissingLayer, match="cleaning"):
        jobs.build_marts(spark, jobs.Lake(str(tmp_path)))


def test_null_profile_of_a_load(spark, lake, tmp_path):
    source = tmp_path / "m.csv"
    source.write_text("date,usd_egp_rate\n2024-01-01,30\n2024-01-02,\n")
    other = jobs.Lake(str(tmp_path / "lake"), Tenant("A", "A1"))
    profiles = jobs.load_raw(spark, other, {"market": str(source)})
    assert {r.column_name: r.nulls for r in profiles["market"].collect()} == {"date": 0, "usd_egp_rate": 1}
