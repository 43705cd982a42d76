"""SNK, AGG: tables as versions and batches without their bad rows, checked by reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.registry import query
from millrace.catalog.sinks import _COUNTS, _SLIM, _UPSERT, _counts, _lines
from millrace.operators import states
from millrace.operators.marts import SCORECARD_KEYS
from millrace.schemas import TENANT_KEYS
from millrace.session import scratch_path
from millrace.sinks import snapshots
from millrace.streaming.isolation import IsolatingSink


@query(
    "snk_03_snapshot_refresh",
    "SELECT a.company_id, a.factory_id, a.facility, a.n, a.tons, b.n AS n_before FROM ("
    + _COUNTS.format(rows="(SELECT * FROM prod WHERE NOT (factory_id = 'ASIA_0' AND efficiency_pct > 50)) AS p")
    + ") AS a JOIN (" + _COUNTS.format(rows="prod") + ") AS b USING (company_id, factory_id, facility)",
)
def _(f):
    path = scratch_path(f.spark, "versions")
    rows = f.production.select(*_SLIM)
    first = snapshots.replace_all(rows, path, TENANT_KEYS)
    mine = rows.filter(TEST_TENANT.predicate()).filter("efficiency_pct <= 50")
    snapshots.replace_tenant(mine, path, TEST_TENANT)
    before = _counts(snapshots.read_snapshot(f.spark, path, version=first.version))
    now = _counts(snapshots.read_snapshot(f.spark, path))
    keys = ["company_id", "factory_id", "facility"]
    return now.join(before.select(*keys, F.col("n").alias("n_before")), keys)


@query(
    "snk_03_snapshot_tenant_scan",
    _COUNTS.format(rows="(SELECT * FROM prod WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0') AS p"),
)
def _(f):
    path = scratch_path(f.spark, "versions")
    snapshots.replace_all(f.production.select(*_SLIM), path, TENANT_KEYS)
    return _counts(snapshots.read_snapshot(f.spark, path, TEST_TENANT))


def _merged(f, update):
    path = scratch_path(f.spark, "versions")
    lines = _lines(f)
    old, new = (lines.filter(c).drop("l_returnflag") for c in ("l_returnflag = 'A'", "l_returnflag <> 'A'"))
    one = lambda df: df.groupBy("k").agg(F.min(F.struct(*[c for c in df.columns if c != "k"])).alias("r")).select("k", "r.*")
    snapshots.replace_all(one(old), path, ["k"])
    snapshots.merge_rows(one(new).select(*old.columns), path, ["k"], update=update)
    return snapshots.read_snapshot(f.spark, path).select(*old.columns)


@query("snk_13_touched_files", _UPSERT.format(old=1, new=0))
def _(f):
    return _merged(f, True)


@query("snk_13_untouched_files", _UPSERT.format(old=0, new=1))
def _(f):
    return _merged(f, False)


_PROFILED = ["company_id", "factory_id", "order_id", "order_date", "delivery_governorate", "actual_delivery", "status"]


@query(
    "agg_09_written_nulls",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS total_rows FROM ord" for c in _PROFILED),
)
def _(f):
    path = scratch_path(f.spark, "versions")
    snapshots.replace_all(f.orders.select(*_PROFILED), path, TENANT_KEYS)
    return snapshots.statistics(f.spark, path).select(F.explode("nulls").alias("column_name", "nulls"), F.col("rows").alias("total_rows"))


@query(
    "agg_37_written_statistics",
    """SELECT 'orders_clean' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE is_large_order = 1) AS flagged_rows,
              avg(quantity_tons) AS mean_value FROM ord_c
       UNION ALL
       SELECT 'shipments_clean', count(*), count(*) FILTER (WHERE is_efficient = 1), avg(transit_days) FROM ship_c""",
    r4="mean_value",
)
def _(f):
    def written(df, name, flagged, mean):
        path = scratch_path(f.spark, "versions")
        measures = {"flagged": F.count_if(flagged), "mean": F.avg(mean)}
        snapshots.replace_all(df, path, TENANT_KEYS, measures)
        return snapshots.statistics(f.spark, path).select(
            F.lit(name).alias("table_name"), F.col("rows").alias("total_rows"),
            F.col("measures.flagged").cast("long").alias("flagged_rows"), F.col("measures.mean").alias("mean_value"),
        )

    return written(f.orders_clean, "orders_clean", F.col("is_large_order") == 1, "quantity_tons").unionByName(
        written(f.shipments_clean, "shipments_clean", F.col("is_efficient") == 1, "transit_days")
    )


@query(
    "snk_10_bad_rows",
    """SELECT event_id, event_type, CASE WHEN event_id % 5000 = 7 THEN 'refused' ELSE 'stored' END AS outcome FROM events""",
)
def _(f):
    root = scratch_path(f.spark, "isolated")

    def accept(batch):
        if (batch.column("event_id").to_numpy() % 5000 == 7).any():
            raise ValueError("refused")

    sink = IsolatingSink(f"{root}/rows", f"{root}/dead", "events", TEST_TENANT, stream="events", accept=accept)
    rows = f.table("events").select("event_id", "event_type")
    for _ in range(2):  # the batch and its replay
        sink(rows, 0)
    kept = f.spark.read.parquet(f"{root}/rows").select("event_id", "event_type", F.lit("stored").alias("outcome"))
    dead = f.spark.read.schema("error string, record string").json(f"{root}/dead")
    record = F.from_json("record", rows.schema)
    return kept.unionByName(dead.select(record["event_id"].alias("event_id"), record["event_type"].alias("event_type"), F.col("error").alias("outcome")))


@query(
    "agg_05_incremental_totals", "SELECT * FROM sup_t",
    r4="total_quantity_tons avg_price_per_ton_usd avg_lead_time_days avg_reliability price_volatility",
)
def _(f):
    path = scratch_path(f.spark, "states")
    late, early = F.crc32(F.col("purchase_id").cast("binary")) % 10 == 0, F.month("purchase_date") <= 6
    part = F.when(late, 2).when(early, 0).otherwise(1)  # two halves of the year, then late rows of all days
    there = F.when(F.col("purchase_id").isNotNull(), True)  # ids are counted only
    rows = f.purchases_stored(
        *SCORECARD_KEYS, "purchase_date", "on_time", "quantity_tons", "price_per_ton_usd", "lead_time_days",
        "supplier_reliability", there.alias("purchase_id"), part.alias("part"), by=["part"],
    )
    for at in range(3):
        states.add_purchases(rows.filter(F.col("part") == at), path)
    states.compact_purchases(f.spark, path)
    return states.supplier_totals(snapshots.read_snapshot(f.spark, path))


def _kpi_states(f, **facts):
    """States of facts that came in two batches, the second with late rows of all days and given twice."""
    kept = states.KpiStates(scratch_path(f.spark, "kpi-states"))
    ids = {"production": "batch_id", "orders": "order_id", "shipments": "shipment_id"}
    for at, late in [(0, False), (1, True), (1, True)]:
        part = {n: df.filter((F.crc32(F.col(ids[n]).cast("binary")) % 10 == 0) == late) for n, df in facts.items()}
        kept.add(**part, batch=at)
    return kept


@query(
    "agg_01_incremental_days", "SELECT * FROM d_prod", r4="total_production_tons avg_efficiency total_waste_tons total_energy_kwh",
)
def _(f):
    path = _kpi_states(f, production=f.production).path
    return states.production_days(states.production_states().read(f.spark, f"{path}/production"))


@query("agg_02_incremental_days", "SELECT * FROM d_ord", r4="total_order_tons total_revenue_egp avg_order_size_tons")
def _(f):
    path = _kpi_states(f, orders=f.orders).path
    return states.order_days(states.order_states().read(f.spark, f"{path}/orders"))


@query(
    "agg_03_incremental_days", "SELECT * FROM d_ship",
    r4="total_logistics_cost_egp total_co2_kg total_fuel_liters avg_cost_per_ton_km",
)
def _(f):
    path = _kpi_states(f, shipments=f.shipments).path
    return states.shipment_days(states.shipment_states().read(f.spark, f"{path}/shipments"))


@query(
    "jn_02_incremental_star", "SELECT * FROM kpi",
    r4="total_production_tons avg_efficiency total_waste_tons total_revenue_egp avg_order_size_tons "
    "total_logistics_cost_egp total_co2_kg steel_price_egp usd_egp_rate",
    r2="profit_estimate_egp",
)
def _(f):
    return _kpi_states(f, production=f.production, orders=f.orders, shipments=f.shipments).daily(f.market)


@query(
    "jn_03_incremental_summary", "SELECT * FROM mon",
    r4="total_production_tons total_revenue_egp avg_efficiency total_co2_kg avg_steel_price_egp avg_usd_rate",
    r2="gross_margin_pct",
)
def _(f):
    kept = _kpi_states(f, production=f.production, orders=f.orders, shipments=f.shipments)
    kept.compact(f.spark)
    return kept.monthly(f.market)
