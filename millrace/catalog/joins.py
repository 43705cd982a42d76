"""JN: enrichment, star and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.registry import query
from millrace.operators import alerts, directory, marts
from millrace.plans.joins import attach_market


@query(
    "jn_01_production_market",
    """SELECT batch_id, date, electricity_price_egp_kwh, natural_gas_price_usd, usd_egp_rate
       FROM prod LEFT JOIN (SELECT date, electricity_price_egp_kwh, natural_gas_price_usd, usd_egp_rate FROM mkt) AS m
       USING (date)""",
    r4="electricity_price_egp_kwh natural_gas_price_usd usd_egp_rate",
)
def _(f):
    cols = ["electricity_price_egp_kwh", "natural_gas_price_usd", "usd_egp_rate"]
    return attach_market(f.production, "date", f.market, {c: c for c in cols}).select("batch_id", "date", *cols)


@query(
    "jn_01_orders_market",
    "SELECT order_id, order_date, steel_price_at_order, usd_rate_at_order FROM ord_c",
    r4="steel_price_at_order usd_rate_at_order",
)
def _(f):
    return f.orders_clean.select("order_id", "order_date", "steel_price_at_order", "usd_rate_at_order")


@query(
    "jn_01_purchases_market",
    "SELECT purchase_id, purchase_date, usd_rate_at_purchase FROM purch_c",
    r4="usd_rate_at_purchase",
)
def _(f):
    return f.purchases_clean.select("purchase_id", "purchase_date", "usd_rate_at_purchase")


@query(
    "jn_02_daily_kpi_star",
    "SELECT * FROM kpi",
    r4="total_production_tons avg_efficiency total_waste_tons total_revenue_egp avg_order_size_tons "
    "total_logistics_cost_egp total_co2_kg steel_price_egp usd_egp_rate",
    r2="profit_estimate_egp",
)
def _(f):
    return f.daily_kpis


@query(
    "jn_03_monthly_summary",
    "SELECT * FROM mon",
    r4="total_production_tons total_revenue_egp avg_efficiency total_co2_kg avg_steel_price_egp avg_usd_rate",
    r2="gross_margin_pct",
)
def _(f):
    return f.monthly_summary


@query(
    "jn_04_orders_with_freight",
    """SELECT order_id, count(*) AS pair_rows, count(transport_cost_egp) AS n_costs, sum(transport_cost_egp) AS cost_sum
       FROM pairs GROUP BY order_id""",
    r4="cost_sum",
)
def _(f):
    pairs = marts.orders_with_freight(f.orders, f.shipments)
    return pairs.select(
        "order_id", F.col("fanout").alias("pair_rows"), F.coalesce("n_costs", F.lit(0)).alias("n_costs"), "cost_sum"
    )


@query(
    "jn_05_purchases_local_price",
    """SELECT purchase_id, usd_egp_rate, CAST(round(CAST(CAST(price_per_ton_usd * coalesce(usd_egp_rate,
       CAST(30 AS DOUBLE)) AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS price_per_ton_egp
       FROM purch LEFT JOIN (SELECT date, usd_egp_rate FROM mkt) AS m ON purchase_date = date""",
    r4="usd_egp_rate",
)
def _(f):
    return marts.purchases_in_local_currency(f.purchases, f.market).select(
        "purchase_id", "usd_egp_rate", "price_per_ton_egp"
    )


@query("jn_06_demand_with_market", "SELECT * FROM dem", r4="log1p_demand")
def _(f):
    from millrace.ml import features

    return features.demand_features(f.orders_regional, f.market)


@query(
    "jn_07_tenant_directory",
    """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS username, company_id, factory_id, n_name AS factory_name
       FROM customer JOIN (SELECT DISTINCT company_id, n_nationkey FROM places) AS c ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT n_nationkey, factory_id, n_name FROM places WHERE n_nationkey < 20) AS f
       ON c_nationkey = f.n_nationkey""",
)
def _(f):
    places = f.places.withColumn("unit", F.col("n_nationkey").cast("string"))
    users = f.table("customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_nationkey").cast("string").alias("unit"),
    )
    users = users.join(places.select("unit", "company_id"), "unit")
    companies = places.select("company_id").distinct()
    factories = places.filter("n_nationkey < 20").select("unit", "factory_id", F.col("n_name").alias("factory_name"))
    return directory.tenant_directory(users, companies, factories, factory_key="unit").select(
        "user_id", "username", "company_id", "factory_id", "factory_name"
    )


# Subscriptions of the test data: one row per supplier's tenant; every fifth supplier speaks for the company.
SUBSCRIPTIONS = """(SELECT company_id, CASE WHEN s_suppkey % 5 = 0 THEN 'ALL_FACTORIES' ELSE factory_id END AS factory_id,
    min(s_name) AS notify_email, s_acctbal > 0 AS enabled
    FROM supplier JOIN places ON s_nationkey = n_nationkey GROUP BY ALL)"""


def subscriptions(f):
    return (
        f.table("supplier")
        .join(f.places, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(
            "company_id",
            F.when(F.col("s_suppkey") % 5 == 0, "ALL_FACTORIES").otherwise(F.col("factory_id")).alias("factory_id"),
            (F.col("s_acctbal") > 0).alias("enabled"),
        )
        .agg(F.min("s_name").alias("notify_email"))
    )


@query(
    "jn_08_recipients",
    f"""SELECT company_id, factory_id, notify_email FROM (
        SELECT a.company_id, a.factory_id, s.notify_email, row_number() OVER (PARTITION BY a.company_id, a.factory_id
            ORDER BY CASE WHEN s.factory_id = a.factory_id THEN 0 ELSE 1 END, s.notify_email) AS rn
        FROM (SELECT DISTINCT company_id, factory_id FROM prod WHERE efficiency_pct < 70) AS a
        LEFT JOIN (SELECT * FROM {SUBSCRIPTIONS} AS s0 WHERE enabled) AS s
            ON a.company_id = s.company_id AND s.factory_id IN (a.factory_id, 'ALL_FACTORIES')) AS x WHERE rn = 1""",
)
def _(f):
    waiting = f.production.filter("efficiency_pct < 70").select("company_id", "factory_id").distinct()
    return alerts.recipients(waiting, subscriptions(f)).select("company_id", "factory_id", "notify_email")


@query(
    "jn_09_market_alert_fanout",
    f"""SELECT t.company_id, t.factory_id, 'price_spike' AS event_type,
        (SELECT count(*) FROM mkt_c WHERE is_price_spike = 1) AS row_count
        FROM (SELECT DISTINCT company_id, factory_id FROM {SUBSCRIPTIONS} AS s WHERE enabled) AS t""",
)
def _(f):
    spikes = f.market_clean.filter("is_price_spike = 1")
    cols = ["date", "steel_price_egypt_egp", "price_change_pct"]
    return alerts.market_alert(spikes, "price_spike", cols, ["date"], subscriptions(f)).select(
        "company_id", "factory_id", "event_type", "row_count"
    )


@query(
    "jn_10_ownership_accepted",
    """SELECT batch_id, factory_id FROM prod WHERE factory_id IN (SELECT factory_id FROM places
       WHERE company_id = 'ASIA')""",
)
def _(f):
    ok, _bad = directory.check_ownership(f.production, f.places, TEST_TENANT.company_id)
    return ok.select("batch_id", "factory_id")


@query(
    "jn_10_ownership_rejected",
    """SELECT factory_id, count(*) AS rejected_rows FROM prod WHERE factory_id NOT IN (SELECT factory_id FROM places
       WHERE company_id = 'ASIA') GROUP BY factory_id""",
)
def _(f):
    _ok, bad = directory.check_ownership(f.production, f.places, TEST_TENANT.company_id)
    return bad.groupBy("factory_id").agg(F.count(F.lit(1)).alias("rejected_rows"))
