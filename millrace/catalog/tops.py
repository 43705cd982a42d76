"""TOP and SET: ordered reads, limits, set operations and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_COMPANY, TEST_TENANT
from millrace.catalog.feeds_sql import rounded
from millrace.catalog.aggregates import FIXED, _ROLLUP
from millrace.catalog.registry import query
from millrace.functions import series
from millrace.ml import features, metrics
from millrace.operators import alerts, quality, served
from millrace.sinks import merge
from millrace.streaming import monitors
from millrace.tenancy import scope, tenants_of


@query(
    "top_01_worst_lines",
    """SELECT company_id, factory_id, production_line, facility, count(*) AS bad_batches,
       min(efficiency_pct) AS min_eff, avg(efficiency_pct) AS avg_eff_when_bad FROM prod
       WHERE efficiency_pct < 70 AND actual_tons > 0 GROUP BY 1, 2, 3, 4
       ORDER BY bad_batches DESC, company_id, factory_id, production_line, facility LIMIT 5""",
    r4="min_eff avg_eff_when_bad",
)
def _(f):
    return quality.worst_lines(f.production)


@query(
    "top_02_worst_batches",
    f"""SELECT batch_id, date, facility, production_line, shift, actual_tons, efficiency_pct, 1 AS is_underperforming
        FROM {FIXED} AS x WHERE efficiency_pct < 70 AND actual_tons > 0
        ORDER BY efficiency_pct, batch_id, date, facility, production_line, shift, actual_tons LIMIT 10""",
    r4="efficiency_pct",
)
def _(f):
    return quality.worst_batches(quality.repair_production(f.production))


@query(
    "top_03_top_product",
    """SELECT coalesce((SELECT event_type FROM ev GROUP BY event_type
       ORDER BY round(sum(value * 20), 6) DESC, event_type LIMIT 1), 'unknown') AS top_product""",
)
def _(f):
    totals = f.events.groupBy(F.col("event_type").alias("product_type")).agg(
        F.round(F.sum(F.col("value") * 20), 6).alias("qty")
    )
    return totals.agg(monitors.leading_product("product_type", "qty").alias("top_product"))


@query(
    "top_04_safest_suppliers",
    f"SELECT supplier_name, avg_risk_score FROM ({_ROLLUP}) AS r ORDER BY avg_risk_score, supplier_name LIMIT 3",
)
def _(f):
    rolled = metrics.supplier_rollup(features.delivery_risk(f.deliveries), prediction="risk_points")
    return metrics.extremes(rolled).select("supplier_name", "avg_risk_score")


@query(
    "top_04_riskiest_suppliers",
    f"SELECT supplier_name, avg_risk_score FROM ({_ROLLUP}) AS r ORDER BY avg_risk_score DESC, supplier_name LIMIT 3",
)
def _(f):
    rolled = metrics.supplier_rollup(features.delivery_risk(f.deliveries), prediction="risk_points")
    return metrics.extremes(rolled, riskiest=True).select("supplier_name", "avg_risk_score")


@query(
    "top_05_recent_days",
    """SELECT date, factory_id, total_production_tons, total_revenue_egp, avg_efficiency, steel_price_egp, total_co2_kg,
       profit_estimate_egp FROM kpi WHERE company_id = 'ASIA' ORDER BY date DESC, factory_id LIMIT 90""",
    r4="total_production_tons total_revenue_egp avg_efficiency steel_price_egp total_co2_kg", r2="profit_estimate_egp",
)
def _(f):
    mine = f.daily_kpis.transform(scope(TEST_COMPANY)).select(
        "date", "factory_id", "total_production_tons", "total_revenue_egp", "avg_efficiency", "steel_price_egp",
        "total_co2_kg", "profit_estimate_egp",
    )
    return served.recent_days(mine, 90, tie=["factory_id"])


@query(
    "top_06_lines_by_efficiency",
    """SELECT facility, production_line, line_type, total_output_tons, avg_efficiency, downtime_pct, best_shift,
       worst_shift FROM line WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0'""",
    r4="total_output_tons avg_efficiency",
)
def _(f):
    return (
        f.line_efficiency.transform(scope(TEST_TENANT))
        .select(
            "facility", "production_line", "line_type", "total_output_tons", "avg_efficiency", "downtime_pct",
            "best_shift", "worst_shift",
        )
        .orderBy("avg_efficiency", "production_line", "line_type")
    )


@query(
    "top_06_regions_by_revenue",
    """SELECT governorate, region, total_orders, total_quantity_tons, total_revenue_egp, avg_delivery_days, delay_pct,
       top_product FROM reg WHERE company_id = 'ASIA'""",
    r4="total_quantity_tons avg_delivery_days",
    r2="total_revenue_egp",
)
def _(f):
    return (
        f.regional_demand.transform(scope(TEST_COMPANY))
        .select(
            "governorate", "region", "total_orders", "total_quantity_tons", "total_revenue_egp", "avg_delivery_days",
            "delay_pct", "top_product",
        )
        .orderBy(F.desc("total_revenue_egp"), "governorate")
    )


@query(
    "top_06_suppliers_by_risk",
    """SELECT supplier_name, origin_country, material_type, total_purchases, avg_price_per_ton_usd, avg_lead_time_days,
       on_time_pct, risk_score FROM sup WHERE company_id = 'ASIA'""",
    r4="avg_price_per_ton_usd avg_lead_time_days",
)
def _(f):
    return (
        f.supplier_scorecard.transform(scope(TEST_COMPANY))
        .select(
            "supplier_name", "origin_country", "material_type", "total_purchases", "avg_price_per_ton_usd",
            "avg_lead_time_days", "on_time_pct", "risk_score",
        )
        .orderBy(F.desc("risk_score"), "supplier_name", "material_type")
    )


@query(
    "top_06_months_in_order",
    "SELECT company_id, factory_id, month_start, total_revenue_egp, gross_margin_pct FROM mon",
    r4="total_revenue_egp",
)
def _(f):
    cols = ["company_id", "factory_id", "month_start", "total_revenue_egp", "gross_margin_pct"]
    return f.monthly_summary.select(*cols).orderBy("month_start", "company_id", "factory_id")


@query(
    "top_07_price_alert_rows",
    """SELECT date, steel_price_egypt_egp, price_change_pct FROM mkt_c WHERE is_price_spike = 1
       ORDER BY date DESC LIMIT 20""",
    r4="steel_price_egypt_egp",
)
def _(f):
    return served.price_alert_rows(f.market_clean)


INBOX = """(SELECT event_id AS id, 'ASIA' AS company_id, 'ASIA_' || (user_id % 2) AS factory_id, event_type,
    k % 3 = 0 AS seen, ts AS created_at FROM ev)"""


def inbox_rows(f):
    """Events read as inbox rows of one company."""
    return f.events.select(
        F.col("event_id").alias("id"),
        F.lit("ASIA").alias("company_id"),
        F.concat(F.lit("ASIA_"), (F.col("user_id") % 2).cast("string")).alias("factory_id"),
        "event_type",
        (F.col("k") % 3 == 0).alias("seen"),
        F.col("ts").alias("created_at"),
    )


@query(
    "top_08_latest_notifications",
    f"""SELECT id, event_type, seen FROM {INBOX} AS i WHERE factory_id = 'ASIA_0' AND NOT seen
        ORDER BY created_at DESC, id DESC LIMIT 50""",
)
def _(f):
    return alerts.inbox(inbox_rows(f), TEST_TENANT, unseen_only=True).select("id", "event_type", "seen")


@query(
    "top_09_sample_per_tenant",
    """SELECT company_id, factory_id, batch_id, efficiency_pct FROM (SELECT *, row_number() OVER (
       PARTITION BY company_id, factory_id ORDER BY efficiency_pct, batch_id, date) AS rn
       FROM prod WHERE efficiency_pct < 70) AS x WHERE rn <= 200""",
    r4="efficiency_pct",
)
def _(f):
    low = f.production.filter("efficiency_pct < 70").select("company_id", "factory_id", "batch_id", "efficiency_pct", "date")
    return series.first_rows(low, ["company_id", "factory_id"], ["efficiency_pct", "batch_id", "date"], 200).drop("date")


@query(
    "top_10_top_governorates",
    f"""SELECT company_id, factory_id, governorate, total_revenue_egp FROM reg
        ORDER BY {rounded('total_revenue_egp', 2)} DESC, governorate LIMIT 15""",
    r2="total_revenue_egp",
)
def _(f):
    return (
        f.regional_demand.select("company_id", "factory_id", "governorate", "total_revenue_egp")
        .orderBy(F.desc(F.round("total_revenue_egp", 2)), "governorate")
        .limit(15)
    )


@query(
    "top_11_daily_series",
    """SELECT company_id, factory_id, date, total_production_tons, total_revenue_egp FROM kpi
       WHERE date >= DATE '2000-01-01' AND date < DATE '2001-01-01'""",
    r4="total_production_tons total_revenue_egp",
)
def _(f):
    from millrace.functions.dates import in_period

    cols = ["company_id", "factory_id", "date", "total_production_tons", "total_revenue_egp"]
    return in_period(f.daily_kpis, "date", "2000").select(*cols).orderBy("date", "company_id", "factory_id")


@query(
    "set_01_row_counts",
    """SELECT 'daily_kpis' AS tbl, count(*) AS n FROM kpi UNION ALL
       SELECT 'supplier_scorecard', count(*) FROM sup UNION ALL SELECT 'regional_demand', count(*) FROM reg UNION ALL
       SELECT 'production_efficiency', count(*) FROM line UNION ALL SELECT 'market_clean', count(*) FROM mkt_c""",
)
def _(f):
    return served.row_counts(
        {
            "daily_kpis": f.daily_kpis,
            "supplier_scorecard": f.supplier_scorecard,
            "regional_demand": f.regional_demand,
            "production_efficiency": f.line_efficiency,
            "market_clean": f.market_clean,
        }
    )


@query("set_02_tenant_pairs", "SELECT DISTINCT company_id, factory_id FROM prod")
def _(f):
    return tenants_of(f.production)


@query(
    "set_03_dedupe_on_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (
       PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) AS x
       WHERE rn = 1""",
)
def _(f):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = f.table("lineitem").select(*cols)
    return merge.one_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


@query(
    "set_04_distinct_values",
    "SELECT count(DISTINCT product_type) AS products, count(DISTINCT region) AS regions FROM dem",
)
def _(f):
    rows = features.demand_features(f.orders_regional, f.market)
    return rows.agg(
        F.count_distinct("product_type").alias("products"), F.count_distinct("region").alias("regions")
    )
