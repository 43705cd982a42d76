"""AGG: aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.feeds_sql import rounded, steady
from millrace.catalog.registry import query
from millrace.ml import features, metrics
from millrace.operators import alerts, cleaning, marts, quality, served
from millrace.tenancy import scope


@query(
    "agg_01_daily_production", "SELECT * FROM d_prod",
    r4="total_production_tons avg_efficiency total_waste_tons total_energy_kwh",
)
def _(f):
    return marts.daily_production(f.production)


@query("agg_02_daily_orders", "SELECT * FROM d_ord", r4="total_order_tons total_revenue_egp avg_order_size_tons")
def _(f):
    return marts.daily_orders(f.orders)


@query(
    "agg_03_daily_shipments", "SELECT * FROM d_ship",
    r4="total_logistics_cost_egp total_co2_kg total_fuel_liters avg_cost_per_ton_km",
)
def _(f):
    return marts.daily_shipments(f.shipments)


@query(
    "agg_04_monthly_totals", "SELECT * FROM mon_t",
    r4="total_production_tons total_revenue_egp total_logistics_cost_egp avg_efficiency total_co2_kg "
    "avg_steel_price_egp avg_usd_rate",
)
def _(f):
    return marts.monthly_totals(f.daily_kpis)


@query(
    "agg_05_supplier_totals", "SELECT * FROM sup_t",
    r4="total_quantity_tons avg_price_per_ton_usd avg_lead_time_days avg_reliability price_volatility",
)
def _(f):
    return marts.supplier_totals(f.purchases_timed)


@query(
    "agg_06_regional_demand", "SELECT * FROM reg",
    r4="total_quantity_tons avg_order_size_tons avg_delivery_days avg_transport_cost_egp",
    r2="total_revenue_egp",
)
def _(f):
    return f.regional_demand


LINE_R4 = "total_output_tons avg_efficiency avg_waste_pct avg_quality_score energy_per_ton_kwh gas_per_ton_m3"


@query("agg_07_line_totals", "SELECT * EXCLUDE (avg_waste_tons) FROM line_t", r4=LINE_R4)
def _(f):
    return marts.line_totals(f.production)


@query("agg_07_line_efficiency_mart", "SELECT * FROM line", r4=LINE_R4)
def _(f):
    return f.line_efficiency


@query("agg_08_shift_means", "SELECT * FROM shift_m", r4="avg_eff_shift")
def _(f):
    return marts.shift_means(f.production)


_ORDER_COLS = [
    "company_id", "factory_id", "order_id", "order_date", "customer_id", "customer_type", "product_type", "quantity_tons",
    "price_per_ton_egp", "total_value_egp", "delivery_governorate", "expected_delivery", "actual_delivery", "delay_days",
    "is_delayed", "status",
]


@query(
    "agg_09_null_profile",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM ord" for c in _ORDER_COLS),
)
def _(f):
    return quality.null_profile(f.orders.select(*_ORDER_COLS))


@query(
    "agg_10_efficiency_distribution",
    """SELECT min(efficiency_pct) AS min_eff, max(efficiency_pct) AS max_eff, avg(efficiency_pct) AS avg_eff,
       quantile_disc(efficiency_pct, 0.05) AS p5, quantile_disc(efficiency_pct, 0.25) AS p25,
       quantile_disc(efficiency_pct, 0.5) AS p50, quantile_disc(efficiency_pct, 0.75) AS p75,
       quantile_disc(efficiency_pct, 0.95) AS p95 FROM prod""",
    r4="min_eff max_eff avg_eff p5 p25 p50 p75 p95",
)
def _(f):
    return quality.efficiency_distribution(f.production)


@query(
    "agg_11_outlier_counts",
    """SELECT count(*) FILTER (efficiency_pct = 0 AND actual_tons > 0) AS zero_efficiency,
       count(*) FILTER (efficiency_pct < 0) AS negative_efficiency,
       count(*) FILTER (efficiency_pct < 70 AND efficiency_pct > 0 AND actual_tons > 0) AS low_efficiency,
       count(*) FILTER (actual_tons = 0 OR actual_tons IS NULL) AS zero_output,
       count(*) FILTER (efficiency_pct > 100) AS over_100 FROM prod""",
)
def _(f):
    return quality.outlier_counts(f.production)


def _bad_sql(by: str) -> str:
    return f"""SELECT company_id, factory_id, {by}, count(*) AS bad_batches, min(efficiency_pct) AS min_eff,
        avg(efficiency_pct) AS avg_eff_when_bad FROM prod WHERE efficiency_pct < 70 AND actual_tons > 0
        GROUP BY company_id, factory_id, {by}"""


@query("agg_12_bad_by_facility", _bad_sql("facility"), r4="min_eff avg_eff_when_bad")
def _(f):
    return quality.bad_batches_by(f.production, ["facility"])


@query("agg_12_bad_by_shift", _bad_sql("shift"), r4="min_eff avg_eff_when_bad")
def _(f):
    return quality.bad_batches_by(f.production, ["shift"])


@query("agg_12_bad_by_line", _bad_sql("production_line"), r4="min_eff avg_eff_when_bad")
def _(f):
    return quality.bad_batches_by(f.production, ["production_line"])


FIXED_EFF = f"""CASE WHEN efficiency_pct > 100 AND actual_tons > 0
    THEN {rounded('least(actual_tons / planned_tons * 100, 100.0)', 2)} ELSE efficiency_pct END"""
FIXED = f"(SELECT * REPLACE ({FIXED_EFF} AS efficiency_pct) FROM prod)"


@query(
    "agg_13_repaired_line_mart",
    f"""SELECT company_id, factory_id, production_line, facility, line_type, sum(actual_tons) AS total_output_tons,
        avg(efficiency_pct) AS avg_efficiency, avg(waste_tons) AS avg_waste_pct, avg(quality_score) AS avg_quality_score,
        avg(CASE WHEN actual_tons > 0 THEN energy_kwh / actual_tons END) AS energy_per_ton_kwh,
        avg(CASE WHEN actual_tons > 0 THEN natural_gas_m3 / actual_tons END) AS gas_per_ton_m3,
        count(batch_id) AS total_batches,
        {rounded("count(*) FILTER (status IN ('maintenance', 'power_outage')) / CAST(count(*) AS DOUBLE) * 100", 2)}
            AS downtime_pct
        FROM {FIXED} AS x GROUP BY company_id, factory_id, production_line, facility, line_type""",
    r4=LINE_R4,
)
def _(f):
    return marts.line_totals(quality.repair_production(f.production), waste_col="waste_tons")


def _summary_sql(by: str) -> str:
    return f"""SELECT company_id, factory_id, {by}, count(*) AS batches, avg(efficiency_pct) AS avg_eff,
        min(efficiency_pct) AS min_eff, max(efficiency_pct) AS max_eff FROM {FIXED} AS x
        GROUP BY company_id, factory_id, {by}"""


@query("agg_14_shift_summary", _summary_sql("shift"), r4="avg_eff min_eff max_eff")
def _(f):
    return quality.efficiency_summary(quality.repair_production(f.production), ["shift"])


@query("agg_14_facility_summary", _summary_sql("facility"), r4="avg_eff min_eff max_eff")
def _(f):
    return quality.efficiency_summary(quality.repair_production(f.production), ["facility"])


@query(
    "agg_15_repair_audit",
    f"""SELECT (SELECT count(*) FROM prod) AS rows_before,
        (SELECT count(*) FROM prod WHERE efficiency_pct < 70 AND actual_tons > 0) AS bad_before,
        count(*) AS rows_after, count(*) - count(efficiency_pct) AS null_efficiency,
        count(*) FILTER (efficiency_pct < 0) AS negative_efficiency,
        count(*) FILTER (actual_tons = 0 OR actual_tons IS NULL) AS zero_output,
        count(*) FILTER (efficiency_pct < 70 AND actual_tons > 0) AS bad_after,
        (SELECT count(*) FROM prod) - count(*) AS removed_rows FROM {FIXED} AS x""",
)
def _(f):
    return quality.repair_audit(f.production, quality.repair_production(f.production))


@query(
    "agg_15_repair_counts",
    f"""SELECT count(*) FILTER (efficiency_pct > 100 AND actual_tons > 0) AS capped_efficiency,
        count(*) FILTER (actual_tons = 0 AND {FIXED_EFF} = 0) AS idle_flag_cleared,
        count(*) FILTER (net_output_tons <> greatest(actual_tons - waste_tons, 0.0)) AS net_output_rederived
        FROM prod_c""",
)
def _(f):
    return quality.repair_counts(f.production_flagged)


@query("agg_16_weekly_demand", "SELECT * FROM wk")
def _(f):
    cols = ["week_of_year", "month_val", "quarter_val", "year_val"]
    return features.weekly_demand(f.orders_regional).drop(*cols)


@query("agg_17_weekly_market", "SELECT * FROM wk_mkt")
def _(f):
    return features.weekly_market(f.market)


@query("agg_17_weekly_market_of_copies", "SELECT * FROM wk_mkt")
def _(f):
    """The market under two tenants, the second with other values and not on all days: each day counts once."""
    copy = f.market.filter(F.dayofmonth("date") % 3 == 0).withColumns(
        {"company_id": F.lit("OTHER"), "steel_price_egypt_egp": F.col("steel_price_egypt_egp") * 3}
    )
    return features.weekly_market(f.market.unionByName(copy))


# The model's score is not an SQL value; the roll-up is checked with the risk points in its place.
_ROLLUP = f"""SELECT supplier_name, min(origin_country) AS origin_country, min(material_type) AS material_type,
    {steady('avg(risk_points)', 2)} AS avg_risk_score, {steady('avg(risk_points)', 2)} AS actual_avg_risk,
    count(*) AS total_deliveries, {steady('avg(is_late) * 100', 2)} AS late_delivery_pct,
    {steady('avg(quality_num)', 2)} AS avg_quality, {steady('avg(lead_time_days)', 1)} AS avg_lead_time,
    {steady('avg(price_per_ton_usd)', 2)} AS avg_price_usd,
    {steady('avg(supplier_reliability)', 4)} AS avg_reliability FROM risk GROUP BY supplier_name"""
_FACTORS = f"""SELECT *, {rounded('(100 - late_delivery_pct)', 2)} AS on_time_factor,
    {rounded('(avg_quality / 4 * 100)', 2)} AS quality_factor,
    CAST(CASE WHEN avg_price_usd > 200 THEN 40 WHEN avg_price_usd > 100 THEN 60 WHEN avg_price_usd > 50 THEN 80
         ELSE 90 END AS DOUBLE) AS price_factor FROM ({_ROLLUP}) AS r"""


@query("agg_18_supplier_rollup", _FACTORS)
def _(f):
    return metrics.supplier_rollup(features.delivery_risk(f.deliveries), prediction="risk_points")


@query(
    "agg_19_risk_levels",
    f"""SELECT supplier_name, avg_risk_score, CASE WHEN avg_risk_score >= hi THEN 'HIGH'
        WHEN avg_risk_score >= lo THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
        FROM ({_ROLLUP}) AS r, (SELECT quantile_disc(avg_risk_score, 0.33) AS lo,
                                quantile_disc(avg_risk_score, 0.67) AS hi FROM ({_ROLLUP}) AS r2) AS t""",
)
def _(f):
    rolled = metrics.supplier_rollup(features.delivery_risk(f.deliveries), prediction="risk_points")
    return metrics.risk_levels(rolled).select("supplier_name", "avg_risk_score", "risk_level")


@query("agg_20_label_distribution", "SELECT risk_label, count(*) AS n_rows FROM risk GROUP BY 1")
def _(f):
    return metrics.label_counts(features.delivery_risk(f.purchases_timed), "risk_label")


@query(
    "agg_20_confusion_late_vs_label",
    "SELECT risk_label, is_late, count(*) AS n_rows FROM risk GROUP BY 1, 2",
)
def _(f):
    return metrics.label_counts(features.delivery_risk(f.purchases_timed), "risk_label", "is_late")


_COMPLETE = "(SELECT * FROM feat WHERE price_lag_30d IS NOT NULL AND price_volatility_7d IS NOT NULL)"
_METRICS = """SELECT sqrt(avg((p - a) * (p - a))) AS rmse, avg(abs(p - a)) AS mae,
    avg(abs(p - a)) / avg(a) * 100 AS mape, avg(abs((p - a) / nullif(a, 0))) * 100 AS mape_true,
    1 - sum((p - a) * (p - a)) / sum((a - m) * (a - m)) AS r2, count(*) AS n_rows FROM {rows}"""


@query(
    "agg_21_regression_metrics",
    _METRICS.format(
        rows="(SELECT weekly_demand_tons AS a, demand_lag_1w AS p, avg(weekly_demand_tons) OVER () AS m FROM dem) AS x"
    ),
    r4="rmse mae mape mape_true r2",
)
def _(f):
    rows = features.demand_features(f.orders_regional, f.market)
    return metrics.regression_metrics(rows, "weekly_demand_tons", "demand_lag_1w")


@query(
    "agg_22_naive_price_baseline",
    _METRICS.format(
        rows=f"""(SELECT steel_price_egp AS a, price_lag_1d AS p, avg(steel_price_egp) OVER () AS m
            FROM {_COMPLETE} AS c WHERE date > (SELECT max(date) - 60 FROM {_COMPLETE} AS c2)) AS x"""
    ),
    r4="rmse mae mape mape_true r2",
)
def _(f):
    rows = features.price_training_rows(f.price_features)
    _train, test = features.time_split(rows, "date", 60)
    return metrics.regression_metrics(test, "steel_price_egp", "price_lag_1d")


def _errors_sql(by: str) -> str:
    return f"""SELECT {by}, actual_total, predicted_total,
        {rounded('(abs(predicted_total - actual_total) / actual_total * 100)', 2)} AS error_pct
        FROM (SELECT {by}, {steady('sum(weekly_demand_tons)', 2)} AS actual_total,
              {steady('sum(demand_ma_4w)', 2)} AS predicted_total FROM dem
              WHERE week_start > (SELECT max(week_start) - 28 FROM dem) GROUP BY 1) AS x"""


def _test_weeks(f):
    return features.time_split(features.demand_features(f.orders_regional, f.market), "week_start", 28)[1]


@query("agg_23_error_by_product", _errors_sql("product_type"))
def _(f):
    return metrics.group_errors(_test_weeks(f), "product_type", "weekly_demand_tons", "demand_ma_4w")


@query("agg_23_error_by_region", _errors_sql("region"))
def _(f):
    return metrics.group_errors(_test_weeks(f), "region", "weekly_demand_tons", "demand_ma_4w")


@query(
    "agg_24_tenant_headline",
    """SELECT coalesce(sum(total_production_tons), 0) AS total_production_tons,
       coalesce(sum(total_revenue_egp), 0) AS total_revenue_egp,
       CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders, coalesce(sum(total_co2_kg), 0) AS total_co2_kg,
       coalesce(sum(profit_estimate_egp), 0) AS profit_estimate_egp, coalesce(avg(avg_efficiency), 0) AS avg_efficiency
       FROM kpi WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0'""",
    r4="avg_efficiency", r2="total_production_tons total_revenue_egp total_co2_kg profit_estimate_egp",
)
def _(f):
    return served.tenant_headline(f.daily_kpis.transform(scope(TEST_TENANT)))


@query(
    "agg_25_executive_row",
    """SELECT sum(total_production_tons) AS total_production, avg(avg_efficiency) AS avg_efficiency,
       sum(total_revenue_egp) AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS total_orders,
       avg(on_time_delivery_pct) AS on_time_pct, sum(total_co2_kg) AS total_co2, sum(profit_estimate_egp) AS total_profit
       FROM kpi""",
    r4="avg_efficiency on_time_pct", r2="total_production total_revenue total_co2 total_profit",
)
def _(f):
    return served.executive_row(f.daily_kpis)


@query(
    "agg_26_carrier_performance",
    f"""SELECT carrier, count(*) AS shipments, {steady('avg(cost_per_ton)', 2)} AS avg_cost,
        {steady('avg(transit_days)', 1)} AS avg_transit,
        {steady('avg(CASE WHEN delay_days > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100', 1)} AS delay_pct,
        {steady('avg(co2_per_ton)', 1)} AS avg_co2 FROM ship_c GROUP BY carrier""",
)
def _(f):
    return served.carrier_performance(f.shipments_clean)


@query(
    "agg_27_mode_efficiency",
    f"""SELECT transport_mode, count(*) AS shipments, {steady('avg(co2_per_ton)', 1)} AS co2_per_ton,
        {steady('avg(cost_per_ton)', 2)} AS cost_per_ton, {steady('avg(transit_days)', 1)} AS transit
        FROM ship_c GROUP BY transport_mode""",
)
def _(f):
    return served.mode_efficiency(f.shipments_clean)


@query(
    "agg_28_products_by_region",
    """SELECT region, product_type, count(*) AS orders, sum(quantity_tons) AS tons FROM ord
       WHERE status <> 'cancelled' GROUP BY region, product_type""",
)
def _(f):
    return served.products_by_region(f.orders_regional)


@query(
    "agg_29_customer_types",
    """SELECT customer_type, count(*) AS orders, sum(total_value_egp) AS revenue FROM ord
       WHERE status <> 'cancelled' GROUP BY customer_type""",
    r2="revenue",
)
def _(f):
    return served.customer_types(f.orders)


@query(
    "agg_30_forecast_totals",
    """SELECT product_type, sum(weekly_demand_tons) AS actual, sum(demand_ma_4w) AS predicted FROM dem
       WHERE week_start > (SELECT max(week_start) - 28 FROM dem) GROUP BY product_type""",
    r2="actual predicted",
)
def _(f):
    forecasts = _test_weeks(f).select(
        "product_type",
        F.col("weekly_demand_tons").alias("actual_quantity_tons"),
        F.col("demand_ma_4w").alias("predicted_quantity_tons"),
    )
    return served.forecast_totals(forecasts)


@query("agg_31_output_by_facility", "SELECT facility, sum(total_output_tons) AS total FROM line GROUP BY 1", r4="total")
def _(f):
    return served.output_by_facility(f.line_efficiency)


_SERIES = [
    "steel_price_egypt_egp", "iron_ore_price_usd", "scrap_price_usd", "usd_egp_rate", "brent_oil_usd",
    "natural_gas_price_usd",
]


@query(
    "agg_32_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS series_a, '{b}' AS series_b, corr({a}, {b}) AS corr FROM mkt" for a in _SERIES for b in _SERIES
    ),
    r4="corr",
)
def _(f):
    return served.correlation_matrix(f.market, _SERIES)


@query(
    "agg_33_co2_totals",
    """SELECT sum(total_co2_kg) AS total_co2_kg, avg(total_co2_kg) AS monthly_mean_kg, count(*) AS months
       FROM (SELECT month_start, sum(total_co2_kg) AS total_co2_kg FROM mon_t GROUP BY 1) AS c""",
    r2="total_co2_kg monthly_mean_kg",
)
def _(f):
    return served.co2_totals(served.co2_by_month(marts.monthly_totals(f.daily_kpis)))


@query(
    "agg_34_carrier_share",
    """SELECT carrier, count(*) AS shipments, count(*) / CAST((SELECT count(*) FROM ship) AS DOUBLE) * 100 AS share_pct
       FROM ship GROUP BY carrier""",
    r4="share_pct",
)
def _(f):
    return served.with_share(f.shipments.groupBy("carrier").agg(F.count(F.lit(1)).alias("shipments")), "shipments")


@query(
    "agg_35_region_hierarchy",
    """SELECT region, governorate, sum(total_revenue_egp) AS total_revenue_egp,
       CAST(grouping_id(region, governorate) AS INTEGER) AS level FROM reg GROUP BY ROLLUP (region, governorate)""",
    r2="total_revenue_egp",
)
def _(f):
    return served.hierarchy(f.regional_demand, "region", "governorate", "total_revenue_egp")


@query(
    "agg_35_product_hierarchy",
    """SELECT region, product_type, sum(tons) AS tons, CAST(grouping_id(region, product_type) AS INTEGER) AS level
       FROM (SELECT region, product_type, sum(quantity_tons) AS tons FROM ord WHERE status <> 'cancelled' GROUP BY 1, 2)
       AS x GROUP BY ROLLUP (region, product_type)""",
)
def _(f):
    return served.hierarchy(served.products_by_region(f.orders_regional), "region", "product_type", "tons")


@query("agg_35_delay_midpoint", "SELECT median(delay_pct) AS delay_midpoint FROM reg", r4="delay_midpoint")
def _(f):
    return f.regional_demand.agg(F.median("delay_pct").alias("delay_midpoint"))


@query(
    "agg_36_line_headline",
    """SELECT count(*) AS rows, avg(avg_efficiency) AS avg_avg_efficiency, avg(downtime_pct) AS avg_downtime_pct,
       sum(total_output_tons) AS sum_total_output_tons FROM line""",
    r4="avg_avg_efficiency avg_downtime_pct sum_total_output_tons",
)
def _(f):
    return served.headline_of(f.line_efficiency, ["avg_efficiency", "downtime_pct"], ["total_output_tons"])


@query(
    "agg_36_regional_headline",
    """SELECT count(*) AS rows, avg(delay_pct) AS avg_delay_pct,
       CAST(sum(total_orders) AS BIGINT) AS sum_total_orders, sum(total_revenue_egp) AS sum_total_revenue_egp FROM reg""",
    r4="avg_delay_pct", r2="sum_total_revenue_egp",
)
def _(f):
    return served.headline_of(f.regional_demand, ["delay_pct"], ["total_orders", "total_revenue_egp"])


def _stats_sql(name: str, table: str, flagged: str, mean: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS total_rows, count(*) FILTER ({flagged}) AS flagged_rows,
        count(*) FILTER ({flagged}) / CAST(count(*) AS DOUBLE) * 100 AS flagged_pct,
        CAST(coalesce({mean}, 0) AS DOUBLE) AS mean_value FROM {table}"""


@query(
    "agg_37_layer_statistics",
    " UNION ALL ".join(
        [
            _stats_sql("market_clean", "mkt_c", "is_price_spike = 1", "0"),
            _stats_sql("production_clean", "prod_c", "is_underperforming = 1", "0"),
            _stats_sql("orders_clean", "ord_c", "is_large_order = 1", "0"),
            _stats_sql("shipments_clean", "ship_c", "is_efficient = 1", "avg(transit_days)"),
            _stats_sql("rawmat_clean", "purch_c", "on_time = 1", "avg(lead_time_days)"),
        ]
    ),
    r4="flagged_pct mean_value",
)
def _(f):
    stats = cleaning.layer_statistics
    return (
        stats(f.market_clean, "market_clean", F.col("is_price_spike") == 1)
        .unionByName(stats(f.production_clean, "production_clean", F.col("is_underperforming") == 1))
        .unionByName(stats(f.orders_clean, "orders_clean", F.col("is_large_order") == 1))
        .unionByName(stats(f.shipments_clean, "shipments_clean", F.col("is_efficient") == 1, "transit_days"))
        .unionByName(stats(f.purchases_clean, "rawmat_clean", F.col("on_time") == 1, "lead_time_days"))
    )


@query(
    "agg_38_duplicate_keys",
    """SELECT count(*) AS total_rows, count(DISTINCT k) AS distinct_keys, count(*) - count(DISTINCT k) AS duplicates
       FROM (SELECT l_orderkey || '-' || l_linenumber AS k FROM lineitem) AS x""",
)
def _(f):
    keyed = f.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"))
    return quality.duplicate_report(keyed, "k")


@query(
    "agg_39_inbox_counts",
    """SELECT count(*) AS total, count(*) FILTER (NOT (k % 3 = 0)) AS unseen FROM ev""",
)
def _(f):
    return alerts.inbox_counts(f.events.withColumn("seen", F.col("k") % 3 == 0))


@query(
    "agg_40_category_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows,
            count(*) / CAST((SELECT count(*) FROM prod) AS DOUBLE) * 100 AS share_pct FROM prod GROUP BY {c}"""
        for c in ["facility", "shift", "status"]
    ),
    r4="share_pct",
)
def _(f):
    return quality.category_profile(f.production, ["facility", "shift", "status"])


@query(
    "agg_40_event_days",
    "SELECT CAST(sum(is_ramadan) AS BIGINT) AS event_days, count(DISTINCT date) AS days FROM mkt",
)
def _(f):
    return f.market.agg(F.sum("is_ramadan").alias("event_days"), F.count_distinct("date").alias("days"))
