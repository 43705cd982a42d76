"""PRJ: tenant scoping, filters, contracts and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_COMPANY, TEST_REGIONS, TEST_TENANT
from millrace.catalog.registry import query
from millrace.functions import dates, guards
from millrace.ml import features
from millrace.operators import directory, quality, served
from millrace.sinks.merge import bools_to_int
from millrace.sources import uploads
from millrace.tenancy import Tenant, run_scope, scope, scope_sizes, strip_reserved, tag, training_scope


@query("prj_01_tenant_tag", "SELECT event_id, 'ASIA' AS company_id, 'ASIA_0' AS factory_id FROM events")
def _(f):
    return tag(f.table("events").select("event_id"), "ASIA", "ASIA_0")


@query("prj_02_run_scope", "SELECT batch_id, company_id, factory_id FROM prod WHERE factory_id = 'ASIA_1'")
def _(f):
    return run_scope(f.production.select("batch_id", "company_id", "factory_id"), None, "ASIA_1")


@query("prj_03_tenant_predicate", "SELECT batch_id FROM prod WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0'")
def _(f):
    return f.production.filter(TEST_TENANT.predicate()).select("batch_id")


@query("prj_03_company_wide", "SELECT batch_id, factory_id FROM prod WHERE company_id = 'ASIA'")
def _(f):
    return f.production.filter(TEST_COMPANY.predicate()).select("batch_id", "factory_id")


@query(
    "prj_04_scoped_query",
    """SELECT facility, count(*) AS n FROM prod WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0' GROUP BY facility""",
)
def _(f):
    return f.production.transform(scope(TEST_TENANT)).groupBy("facility").agg(F.count(F.lit(1)).alias("n"))


@query("prj_05_training_scope_factory", "SELECT order_id, factory_id FROM ord WHERE factory_id = 'ASIA_0'")
def _(f):
    return training_scope(f.orders.select("order_id", "company_id", "factory_id"), TEST_TENANT, "factory").drop("company_id")


@query("prj_05_training_scope_company", "SELECT order_id, factory_id FROM ord WHERE company_id = 'ASIA'")
def _(f):
    rows = f.orders.select("order_id", "company_id", "factory_id")
    return training_scope(rows, Tenant("ASIA", "ASIA_NEW"), "company").drop("company_id")


@query("prj_05_training_scope_all", "SELECT order_id, factory_id FROM ord")
def _(f):
    rows = f.orders.select("order_id", "company_id", "factory_id")
    return training_scope(rows, Tenant("NEWCOMER", "NEWCOMER_0"), "all").drop("company_id")


@query(
    "prj_05_scope_sizes",
    """SELECT count(*) FILTER (WHERE factory_id = 'ASIA_0') AS factory, count(*) FILTER (WHERE company_id = 'ASIA') AS company,
       count(*) AS "all" FROM ord""",
)
def _(f):
    return scope_sizes(f.orders, TEST_TENANT)


@query("prj_06_strip_reserved", "SELECT batch_id, facility FROM prod")
def _(f):
    return strip_reserved(f.production.select("company_id", "factory_id", "batch_id", "facility"))


@query(
    "prj_07_required_columns",
    """SELECT feed, missing, count(*) AS rows_checked FROM (SELECT 'orders' AS feed, '' AS missing FROM ord UNION ALL
       SELECT 'production', 'planned_tons,efficiency_pct' FROM prod) AS x GROUP BY feed, missing""",
)
def _(f):
    partial = f.production.drop("planned_tons", "efficiency_pct")
    checks = []
    for feed, df in [("orders", f.orders), ("production", partial)]:
        gaps = ",".join(uploads.missing_columns(df, feed))
        checks.append(df.agg(F.count(F.lit(1)).alias("rows_checked")).select(F.lit(feed).alias("feed"), F.lit(gaps).alias("missing"), "rows_checked"))
    return checks[0].unionByName(checks[1])


@query(
    "prj_08_drop_null_dates",
    "SELECT order_id, actual_delivery FROM ord WHERE actual_delivery IS NOT NULL",
)
def _(f):
    return f.orders.filter(F.col("actual_delivery").isNotNull()).select("order_id", "actual_delivery")


@query("prj_09_restamp", "SELECT batch_id, TIMESTAMP '2024-12-31 06:00:00' AS loaded_at FROM prod")
def _(f):
    old = f.production.select("batch_id", F.current_timestamp().alias("loaded_at"))
    return dates.stamp(old, at=F.lit("2024-12-31 06:00:00").cast("timestamp_ntz"))


@query("prj_10_bool_to_int", "SELECT shipment_id, CAST(delay_days > 0 AS INTEGER) AS is_delayed FROM ship")
def _(f):
    return bools_to_int(f.shipments.select("shipment_id", (F.col("delay_days") > 0).alias("is_delayed")))


def _period_sql(where: str) -> str:
    return f"SELECT count(*) AS n, min(date) AS first_day, max(date) AS last_day FROM mkt WHERE {where}"


def _period(f, name):
    kept = dates.in_period(f.market, "date", name)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("prj_11_period_all", _period_sql("TRUE"))
def _(f):
    return _period(f, "all")


@query("prj_11_period_year", _period_sql("year(date) = 2000"))
def _(f):
    return _period(f, "2000")


@query("prj_11_period_last_30_days", _period_sql("date >= (SELECT max(date) - 30 FROM mkt)"))
def _(f):
    return _period(f, "last_30_days")


@query("prj_11_period_last_90_days", _period_sql("date >= (SELECT max(date) - 90 FROM mkt)"))
def _(f):
    return _period(f, "last_90_days")


@query("prj_11_period_last_6_months", _period_sql("date >= (SELECT max(date) - 180 FROM mkt)"))
def _(f):
    return _period(f, "last_6_months")


_MAPPED = [name for names in TEST_REGIONS.values() for name in names]


@query("prj_12_known_places", "SELECT order_id, delivery_governorate FROM ord WHERE region <> 'Other'")
def _(f):
    ok, _rejected = directory.known_places(f.orders, "delivery_governorate", _MAPPED)
    return ok.select("order_id", "delivery_governorate")


@query("prj_12_rejected_places", "SELECT order_id, delivery_governorate FROM ord WHERE region = 'Other'")
def _(f):
    _ok, rejected = directory.known_places(f.orders, "delivery_governorate", _MAPPED)
    return rejected.select("order_id", "delivery_governorate")


@query(
    "prj_13_complete_rows",
    "SELECT date, steel_price_egp, price_lag_30d FROM feat WHERE price_lag_30d IS NOT NULL AND price_volatility_7d IS NOT NULL",
    r4="steel_price_egp price_lag_30d",
)
def _(f):
    return features.price_training_rows(f.price_features).select("date", "steel_price_egp", "price_lag_30d")


def _split_sql(rows: str, col: str, days: int) -> str:
    return f"""SELECT {col} <= (SELECT max({col}) - {days} FROM {rows} AS a) AS is_train, count(*) AS n,
        min({col}) AS first_day, max({col}) AS last_day FROM {rows} AS b GROUP BY 1"""


def _split_rows(train, test, col):
    parts = [
        part.agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("first_day"), F.max(col).alias("last_day")).withColumn(
            "is_train", F.lit(side)
        )
        for part, side in ((train, True), (test, False))
    ]
    return parts[0].unionByName(parts[1])


@query("prj_14_price_time_split", _split_sql("(SELECT * FROM feat WHERE price_lag_30d IS NOT NULL AND price_volatility_7d IS NOT NULL)", "date", 60))
def _(f):
    return _split_rows(*features.time_split(features.price_training_rows(f.price_features), "date", 60), "date")


@query("prj_14_demand_time_split", _split_sql("dem", "week_start", 28))
def _(f):
    rows = features.demand_features(f.orders_regional, f.market)
    return _split_rows(*features.time_split(rows, "week_start", 28), "week_start")


@query("prj_14_hash_split")
def _(f):
    train, test = features.hash_split(f.purchases, "purchase_id")
    sides = [part.agg(F.count(F.lit(1)).alias("n")).withColumn("is_train", F.lit(s)) for part, s in ((train, True), (test, False))]
    return sides[0].unionByName(sides[1])


@query(
    "prj_14_digest_split",
    """SELECT ('0x' || substr(md5(purchase_id || '|42'), 1, 8))::BIGINT % 10 < 8 AS is_train, count(*) AS n,
       min(purchase_id) AS first_id, max(purchase_id) AS last_id FROM purch GROUP BY 1""",
)
def _(f):
    both = zip(features.digest_split(f.purchases, "purchase_id"), (True, False))
    seen = [F.count(F.lit(1)).alias("n"), F.min("purchase_id").alias("first_id"), F.max("purchase_id").alias("last_id")]
    train, test = (part.agg(*seen).withColumn("is_train", F.lit(side)) for part, side in both)
    return train.unionByName(test)


@query("prj_15_active_orders", "SELECT order_id, status FROM ord WHERE status <> 'cancelled'")
def _(f):
    return served.active_orders(f.orders).select("order_id", "status")


_CHART = ["steel_price_egypt_egp", "iron_ore_price_usd", "usd_egp_rate", "moving_avg_7d", "price_volatility_7d"]


@query(
    "prj_16_chart_projection",
    f"SELECT date, {', '.join(_CHART)}, is_price_spike FROM mkt_c",
    r4=" ".join(_CHART),
)
def _(f):
    return served.chart_projection(f.market_clean, _CHART).orderBy("date")


@query(
    "prj_17_price_feature_mart",
    "SELECT * FROM feat",
    r4="steel_price_egp iron_ore_price_usd scrap_price_usd usd_egp_rate natural_gas_price_usd brent_oil_usd "
    "electricity_price_egp_kwh seasonality_index price_lag_1d price_lag_7d price_lag_14d price_lag_30d moving_avg_7d "
    "moving_avg_14d moving_avg_30d",
)
def _(f):
    return f.price_features


@query(
    "prj_18_try_casts",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
       CASE WHEN event_type = 'view' THEN NULL ELSE k END AS days, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM ev""",
)
def _(f):
    text = f.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("price"),
        F.when(F.col("event_type") == "view", "late").otherwise(F.col("k").cast("string")).alias("days"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
    )
    return text.select(
        "event_id",
        guards.to_number("price").alias("price"),
        guards.to_whole("days").alias("days"),
        F.date_format(guards.to_time("at"), "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


def _range_sql(feed: str, table: str, checks: dict) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{feed}' AS feed, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value,
            CAST(max({c}) AS DOUBLE) AS max_value, count(*) - count({c}) AS nulls,
            coalesce(min({c}) >= {lo} * 0.8 AND max({c}) <= {hi} * 1.2, FALSE) AS ok FROM {table}"""
        for c, (lo, hi) in checks.items()
    )


@query(
    "prj_19_range_report",
    " UNION ALL ".join(
        [
            _range_sql("production", "prod", {"efficiency_pct": (0, 100), "yield_loss_pct": (0, 15)}),
            _range_sql("orders", "ord", {"quantity_tons": (1, 15000), "price_per_ton_egp": (25000, 70000)}),
            _range_sql("shipments", "ship", {"distance_km": (1, 1000), "cost_per_ton_km_egp": (0.5, 5.0)}),
            _range_sql("raw_materials", "purch", {"quantity_tons": (1, 60000)}),
        ]
    ),
    r4="min_value max_value",
)
def _(f):
    reports = [
        quality.range_report(df, feed)
        for feed, df in [
            ("production", f.production), ("orders", f.orders), ("shipments", f.shipments), ("raw_materials", f.purchases),
        ]
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


