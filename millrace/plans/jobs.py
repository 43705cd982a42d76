"""The layered batch jobs: raw, cleaned, repaired, marts, and the full run.

Each job reads a layer, applies operators and writes tables. Frames used by several actions are
written once and read back, so nothing is computed twice and the next step starts from files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.dates import stamp
from millrace.operators import alerts, cleaning, marts, quality
from millrace.schemas import LAYOUTS, RAW_PARTITION, REGION_GOVERNORATES, TENANT_KEYS
from millrace.session import cut_lineage, scratch_path
from millrace.sinks.tables import write_partitioned, write_raw
from millrace.sources.tables import path_exists, read_feed, read_layer, read_table
from millrace.sources.uploads import take_upload
from millrace.tenancy import Tenant


@dataclass(frozen=True)
class Lake:
    """Where the layers live, and the scope of the run (no company means every tenant)."""

    root: str
    tenant: Tenant = Tenant()
    rates: cleaning.Rates = cleaning.RATES
    limits: cleaning.Limits = cleaning.LIMITS
    regions: dict = field(default_factory=lambda: REGION_GOVERNORATES)
    subscriptions: DataFrame | None = None

    def raw(self, spark: SparkSession, name: str, scoped: bool = True) -> DataFrame:
        return read_layer(spark, f"{self.root}/raw", name, "raw", self.tenant if scoped else None)

    def clean(self, spark: SparkSession, name: str, scoped: bool = True) -> DataFrame:
        return read_layer(spark, f"{self.root}/clean", name, "cleaning", self.tenant if scoped else None)

    def write(self, df: DataFrame, layer: str, table: str) -> None:
        write_partitioned(stamp(df), f"{self.root}/{layer}/{table}", LAYOUTS[table], self.tenant)


def load_raw(spark: SparkSession, lake: Lake, files: dict[str, str]) -> dict[str, DataFrame]:
    """CSV feeds to the raw layer; returns the null profile of each."""
    profiles = {}
    for feed, path in files.items():
        df = read_feed(spark, path, feed)
        write_raw(df, f"{lake.root}/raw/{feed}", feed, lake.tenant)
        profiles[feed] = quality.null_profile(lake.raw(spark, feed).select(*df.columns))
    return profiles


def build_clean(spark: SparkSession, lake: Lake) -> None:
    """Raw to cleaned tables, with alerts. The market is shared, so it is never scoped."""
    lake.write(cleaning.clean_market(lake.raw(spark, "market", scoped=False)), "clean", "market_clean")
    market = lake.clean(spark, "market_clean", scoped=False)
    steps = {
        "production_clean": lambda: cleaning.clean_production(lake.raw(spark, "production"), market, lake.rates, lake.limits),
        "orders_clean": lambda: cleaning.clean_orders(lake.raw(spark, "orders"), market, lake.regions, lake.limits),
        "shipments_clean": lambda: cleaning.clean_shipments(lake.raw(spark, "shipments"), lake.limits),
        "rawmat_clean": lambda: cleaning.clean_purchases(lake.raw(spark, "raw_materials"), market, lake.rates),
    }
    for table, make in steps.items():
        lake.write(make(), "clean", table)
    write_alerts(spark, lake)


LOW_COLS = ["facility", "production_line", "date", "efficiency_pct"]
SPIKE_COLS = ["date", "steel_price_egypt_egp", "price_change_pct"]


def write_alerts(spark: SparkSession, lake: Lake) -> None:
    """Inbox rows with address and channel, and one event row per anomaly, from the cleaned tables.

    A run replaces the alerts of its tenants, so running it again does not double them. Market-wide
    price spikes reach the tenants that subscribe; their events belong to the market's own tenant.
    """
    low = lake.clean(spark, "production_clean").filter("is_underperforming = 1")
    spikes = lake.clean(spark, "market_clean", scoped=False).filter("is_price_spike = 1")
    rows = alerts.tenant_summaries(low, "low_efficiency", LOW_COLS)
    events = alerts.alert_events(low, "low_efficiency", LOW_COLS)
    if lake.subscriptions is not None:
        asked = lake.subscriptions
        if lake.tenant.company_id:
            asked = asked.filter(lake.tenant.predicate())
        rows = rows.unionByName(alerts.market_alert(spikes, "price_spike", SPIKE_COLS, ["date"], asked))
        rows = alerts.recipients(rows, lake.subscriptions)
    if not lake.tenant.company_id:
        events = events.unionByName(alerts.alert_events(spikes, "price_spike", SPIKE_COLS))
    routed = stamp(rows.withColumn("channel", alerts.channel()), "created_at")
    write_partitioned(routed, f"{lake.root}/alerts", TENANT_KEYS, lake.tenant)
    write_partitioned(stamp(events, "created_at"), f"{lake.root}/alert_events", TENANT_KEYS, lake.tenant)


def load_upload(
    spark: SparkSession, lake: Lake, df: DataFrame, feed: str, tenant: Tenant, factories: DataFrame
) -> DataFrame:
    """Append the accepted rows of an upload to the raw layer (SRC-06) and return them.

    They land in a table of their own run first, so the rows that are appended are those that are returned.
    """
    path = f"{lake.root}/raw/{feed}"
    existing = read_table(spark, path) if path_exists(spark, path) else stamp(df.limit(0).withColumns({c: F.lit("") for c in TENANT_KEYS}))
    taken = stamp(take_upload(df, feed, tenant, factories, existing))
    extra = [RAW_PARTITION[feed]] if RAW_PARTITION[feed] else []
    kept = f"{scratch_path(spark, 'upload')}/{feed}"
    taken.write.parquet(kept)
    accepted = read_table(spark, kept)
    accepted.write.mode("append").partitionBy(*TENANT_KEYS, *extra).parquet(path)
    return accepted


MARTS = ["daily_kpis", "monthly_summary", "supplier_scorecard", "regional_demand", "production_efficiency", "price_features"]


def mirror_marts(spark: SparkSession, lake: Lake, write: Callable[[str, DataFrame], None], tables: list[str] | None = None) -> None:
    """Hand each mart of the run's scope to a writer: the warehouse's, or any other that takes (name, rows)."""
    for table in tables or MARTS:
        scope_of = None if table == "price_features" else lake.tenant
        write(table, read_layer(spark, f"{lake.root}/marts", table, "marts", scope_of))


def repair_clean(spark: SparkSession, lake: Lake) -> DataFrame:
    """Correct production in place and return the whole audit row.

    The audit reads the table as it was, so its one row is taken before the table is replaced.
    """
    before = lake.clean(spark, "production_clean")
    fixed = cut_lineage(quality.repair_production(before))
    audit = quality.repair_audit(before, fixed)
    row = audit.first()
    write_partitioned(fixed, f"{lake.root}/clean/production_clean", LAYOUTS["production_clean"], lake.tenant)
    return spark.createDataFrame([row], audit.schema)


def build_marts(spark: SparkSession, lake: Lake) -> None:
    """Cleaned tables to the six marts. The daily table feeds the monthly one from its files."""
    market = lake.clean(spark, "market_clean", scoped=False)
    production = lake.clean(spark, "production_clean")
    orders = lake.clean(spark, "orders_clean")
    shipments = lake.clean(spark, "shipments_clean")
    lake.write(marts.daily_kpis(production, orders, shipments, market), "marts", "daily_kpis")
    daily = read_layer(spark, f"{lake.root}/marts", "daily_kpis", "marts", lake.tenant)
    lake.write(marts.monthly_summary(daily, orders), "marts", "monthly_summary")
    lake.write(marts.supplier_scorecard(lake.clean(spark, "rawmat_clean")), "marts", "supplier_scorecard")
    lake.write(marts.regional_demand(orders, shipments), "marts", "regional_demand")
    lake.write(marts.line_efficiency(production), "marts", "production_efficiency")
    write_partitioned(stamp(marts.price_features(market)), f"{lake.root}/marts/price_features", LAYOUTS["price_features"])


def run_all(spark: SparkSession, lake: Lake, files: dict[str, str] | None = None, repair: bool = True) -> None:
    """Raw (when files are given), cleaned, repaired, marts."""
    if files:
        load_raw(spark, lake, files)
    build_clean(spark, lake)
    if repair:
        repair_clean(spark, lake)
    build_marts(spark, lake)
