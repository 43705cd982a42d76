"""SCL, DAT and STR: derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.aggregates import FIXED_EFF, _FACTORS
from millrace.catalog.feeds import STREAM_BASELINE
from millrace.catalog.feeds_sql import ratio, rounded
from millrace.catalog.registry import query
from millrace.functions import dates, guards, text
from millrace.ml import features, metrics
from millrace.operators import alerts, cleaning, directory, marts, quality, served
from millrace.streaming import monitors


@query("scl_01_spike_flag", "SELECT date, is_price_spike FROM mkt_c")
def _(f):
    return f.market_clean.select("date", "is_price_spike")


@query(
    "scl_02_currency",
    "SELECT date, iron_ore_price_egp, scrap_price_egp FROM mkt_c",
)
def _(f):
    return f.market_clean.select("date", "iron_ore_price_egp", "scrap_price_egp")


@query("scl_02_purchase_currency", "SELECT purchase_id, total_landed_cost_egp, price_per_ton_egp FROM purch_c")
def _(f):
    return f.purchases_clean.select("purchase_id", "total_landed_cost_egp", "price_per_ton_egp")


@query(
    "scl_03_net_output",
    f"""SELECT batch_id, {rounded('(actual_tons - waste_tons)', 2)} AS net_output_tons,
        {rounded('greatest(actual_tons - waste_tons, 0.0)', 2)} AS repaired_net_output_tons FROM prod""",
)
def _(f):
    plain = F.round(F.col("actual_tons") - F.col("waste_tons"), 2)
    return f.production.select(
        "batch_id", plain.alias("net_output_tons"), quality.clamped_net_output().alias("repaired_net_output_tons")
    )


@query(
    "scl_04_guarded_ratios",
    f"""SELECT batch_id, {ratio('energy_kwh', 'actual_tons')} AS energy_per_ton,
        {ratio('natural_gas_m3', 'actual_tons')} AS gas_per_ton FROM prod""",
)
def _(f):
    return f.production.select(
        "batch_id",
        guards.safe_ratio("energy_kwh", "actual_tons").alias("energy_per_ton"),
        guards.safe_ratio("natural_gas_m3", "actual_tons").alias("gas_per_ton"),
    )


@query("scl_04_shipment_ratios", "SELECT shipment_id, cost_per_ton, fuel_per_ton, co2_per_ton FROM ship_c")
def _(f):
    return f.shipments_clean.select("shipment_id", "cost_per_ton", "fuel_per_ton", "co2_per_ton")


@query("scl_05_energy_cost", "SELECT batch_id, estimated_energy_cost_egp FROM prod_c")
def _(f):
    return f.production_clean.select("batch_id", "estimated_energy_cost_egp")


@query(
    "scl_06_shift_rank",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS shift_rank
       FROM ev""",
)
def _(f):
    named = (
        F.when(F.col("event_type") == "view", "morning")
        .when(F.col("event_type") == "click", "afternoon")
        .when(F.col("event_type") == "error", "night")
        .otherwise(F.col("event_type"))
    )
    return f.events.select("event_id", cleaning.shift_rank(named).alias("shift_rank"))


@query("scl_07_underperforming", "SELECT batch_id, is_underperforming FROM prod_c")
def _(f):
    return f.production.select("batch_id", cleaning.underperforming().alias("is_underperforming"))


@query("scl_08_region", "SELECT order_id, delivery_governorate, region FROM ord")
def _(f):
    return f.orders_regional.select("order_id", "delivery_governorate", "region")


@query("scl_09_delivery_score", "SELECT order_id, delivery_performance_score FROM ord_c")
def _(f):
    return f.orders.select("order_id", cleaning.delivery_score().alias("delivery_performance_score"))


@query(
    "scl_10_large_order",
    """SELECT order_id, CAST(coalesce(quantity_tons >= 100, FALSE) AS INTEGER) AS is_large_order,
       CAST(coalesce(quantity_tons * 10 >= 1000, FALSE) AS INTEGER) AS is_large_stream_order FROM ord""",
)
def _(f):
    qty = F.col("quantity_tons")
    return f.orders.select(
        "order_id",
        guards.flag(qty >= cleaning.LIMITS.large_order_tons).alias("is_large_order"),
        guards.flag(qty * 10 >= monitors.LARGE_ORDER_TONS).alias("is_large_stream_order"),
    )


@query("scl_11_efficient_haul", "SELECT shipment_id, is_efficient FROM ship_c")
def _(f):
    return f.shipments_clean.select("shipment_id", "is_efficient")


@query("scl_12_delivery_speed", "SELECT shipment_id, transit_days, delivery_speed_km_per_day FROM ship_c")
def _(f):
    return f.shipments_clean.select("shipment_id", "transit_days", "delivery_speed_km_per_day")


@query("scl_13_profit_estimate", "SELECT company_id, factory_id, date, profit_estimate_egp FROM kpi", r2="profit_estimate_egp")
def _(f):
    return f.daily_kpis.select("company_id", "factory_id", "date", "profit_estimate_egp")


@query("scl_14_gross_margin", "SELECT company_id, factory_id, month_start, gross_margin_pct FROM mon_t")
def _(f):
    return marts.monthly_totals(f.daily_kpis).select("company_id", "factory_id", "month_start", "gross_margin_pct")


@query(
    "scl_15_supplier_scorecard", "SELECT * FROM sup",
    r4="total_quantity_tons avg_price_per_ton_usd avg_lead_time_days avg_reliability avg_quality_grade price_volatility",
)
def _(f):
    return f.supplier_scorecard


@query("scl_16_quality_points", "SELECT purchase_id, quality_grade, quality_num FROM risk")
def _(f):
    return f.purchases.select("purchase_id", "quality_grade", features.quality_points().alias("quality_num"))


@query(
    "scl_17_delivery_risk",
    "SELECT purchase_id, is_late, is_low_quality, is_expensive, risk_points, risk_label FROM risk",
)
def _(f):
    return features.delivery_risk(f.purchases_timed).select(
        "purchase_id", "is_late", "is_low_quality", "is_expensive", "risk_points", "risk_label"
    )


@query(
    "scl_18_supplier_factors",
    f"SELECT supplier_name, on_time_factor, quality_factor, price_factor FROM ({_FACTORS}) AS r",
)
def _(f):
    rolled = metrics.supplier_rollup(features.delivery_risk(f.deliveries), prediction="risk_points")
    return rolled.select("supplier_name", "on_time_factor", "quality_factor", "price_factor")


@query(
    "scl_19_target_transforms",
    """SELECT week_start, product_type, region, ln(1 + weekly_demand_tons) AS log1p_demand,
       greatest(0.0, exp(ln(1 + weekly_demand_tons)) - 1) AS back FROM wk WHERE weekly_demand_tons IS NOT NULL""",
    r4="log1p_demand back",
)
def _(f):
    weekly = features.weekly_demand(f.orders_regional).filter(F.col("weekly_demand_tons").isNotNull())
    log = F.log1p("weekly_demand_tons")
    return weekly.select(
        "week_start", "product_type", "region", log.alias("log1p_demand"), features.back_to_tons(log).alias("back")
    )


@query(
    "scl_19_price_delta",
    """SELECT date, steel_price_egp - price_lag_1d AS price_delta FROM feat
       WHERE price_lag_30d IS NOT NULL AND price_volatility_7d IS NOT NULL""",
    r4="price_delta",
)
def _(f):
    return features.price_training_rows(f.price_features).select("date", "price_delta")


@query(
    "scl_20_confidence_band",
    f"""SELECT date, {rounded('(price_lag_1d * CAST(0.95 AS DOUBLE))', 2)} AS confidence_lower,
        {rounded('(price_lag_1d * CAST(1.05 AS DOUBLE))', 2)} AS confidence_upper FROM feat
        WHERE price_lag_1d IS NOT NULL""",
)
def _(f):
    rows = f.price_features.filter(F.col("price_lag_1d").isNotNull())
    return rows.select("date", *features.confidence_band("price_lag_1d"))


@query("scl_21_capped_efficiency", f"SELECT batch_id, {FIXED_EFF} AS efficiency_pct FROM prod", r4="efficiency_pct")
def _(f):
    return f.production.select("batch_id", quality.capped_efficiency().alias("efficiency_pct"))


@query(
    "scl_22_idle_exemption",
    """SELECT batch_id, CAST(eff < 70 AS INTEGER) AS is_underperforming,
       CASE WHEN actual_tons = 0 AND eff = 0 THEN 0 ELSE CAST(eff < 70 AS INTEGER) END AS exempted
       FROM (SELECT batch_id, actual_tons, CASE WHEN actual_tons = 0 THEN 0 ELSE efficiency_pct END AS eff FROM prod)
       AS x""",
)
def _(f):
    idle = F.when(F.col("actual_tons") == 0, 0.0).otherwise(F.col("efficiency_pct"))
    df = f.production.withColumn("efficiency_pct", idle)
    flags = quality.underperforming_flags()
    return df.select("batch_id", flags["published"].alias("is_underperforming"), flags["exempted"].alias("exempted"))


@query(
    "scl_23_price_alert_level",
    f"""SELECT event_id, {rounded(f'((value - {STREAM_BASELINE}) / {STREAM_BASELINE} * 100)', 2)} AS change_pct,
        CASE WHEN abs(c) > 15 THEN 'CRITICAL' WHEN abs(c) > 10 THEN 'HIGH' WHEN abs(c) > 5 THEN 'MEDIUM' ELSE 'LOW' END
        AS alert_level FROM (SELECT event_id, value,
        {rounded(f'((value - {STREAM_BASELINE}) / {STREAM_BASELINE} * 100)', 2)} AS c FROM events) AS e""",
)
def _(f):
    change = monitors.baseline_change("value", STREAM_BASELINE)
    return f.events.select("event_id", change.alias("change_pct"), monitors.price_level(change).alias("alert_level"))


@query(
    "scl_24_production_alert",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'POWER_OUTAGE' WHEN event_type = 'signup' THEN 'MAINTENANCE'
       WHEN value < 70 THEN 'LOW_EFFICIENCY' WHEN k / 10.0 < 7.0 THEN 'LOW_QUALITY' ELSE 'NORMAL' END AS alert FROM ev""",
)
def _(f):
    status = (
        F.when(F.col("event_type") == "error", "power_outage")
        .when(F.col("event_type") == "signup", "maintenance")
        .otherwise("running")
    )
    alert = monitors.production_alert(status, F.col("value"), F.col("k") / 10)
    return f.events.select("event_id", alert.alias("alert"))


@query("scl_25_shipment_delayed", "SELECT shipment_id, coalesce(delay_days > 0, FALSE) AS is_delayed FROM ship")
def _(f):
    return f.shipments.select("shipment_id", monitors.delayed("delay_days").alias("is_delayed"))


@query(
    "scl_26_display_bands",
    """SELECT company_id, factory_id, supplier_name, material_type,
       CASE WHEN risk_score >= 50 THEN 'red' WHEN risk_score >= 25 THEN 'amber' ELSE 'green' END AS portal_band,
       CASE WHEN risk_score < 34 THEN 'green' WHEN risk_score < 37 THEN 'amber' ELSE 'red' END AS chart_band FROM sup""",
)
def _(f):
    return f.supplier_scorecard.select(
        "company_id", "factory_id", "supplier_name", "material_type",
        served.portal_risk_band().alias("portal_band"), served.chart_risk_band().alias("chart_band"),
    )


@query(
    "scl_26_efficiency_bands",
    """SELECT batch_id, CASE WHEN efficiency_pct < 70 THEN 'red' WHEN efficiency_pct < 85 THEN 'amber' ELSE 'green' END
       AS portal_band, CASE WHEN efficiency_pct > 85 THEN 'green' WHEN efficiency_pct > 80 THEN 'amber' ELSE 'red' END
       AS chart_band FROM prod""",
)
def _(f):
    return f.production.select(
        "batch_id",
        served.portal_efficiency_band("efficiency_pct").alias("portal_band"),
        served.chart_efficiency_band("efficiency_pct").alias("chart_band"),
    )


@query(
    "scl_27_safe_pct",
    """SELECT facility, coalesce(count(*) FILTER (status = 'maintenance') / nullif(CAST(count(*) FILTER (
       efficiency_pct < 0) AS DOUBLE), 0) * 100, 0) AS none_pct, count(*) FILTER (status = 'maintenance')
       / CAST(count(*) AS DOUBLE) * 100 AS idle_pct FROM prod GROUP BY facility""",
    r4="none_pct idle_pct",
)
def _(f):
    counts = f.production.groupBy("facility").agg(
        F.count_if(F.col("status") == "maintenance").alias("idle"),
        F.count_if(F.col("efficiency_pct") < 0).alias("impossible"),
        F.count(F.lit(1)).alias("n"),
    )
    return counts.select(
        "facility",
        guards.safe_pct("idle", "impossible").alias("none_pct"),
        guards.safe_pct("idle", "n").alias("idle_pct"),
    )


@query(
    "dat_01_calendar_parts",
    """SELECT order_id, CAST(year(order_date) AS INTEGER) AS y, CAST(month(order_date) AS INTEGER) AS m,
       CAST(quarter(order_date) AS INTEGER) AS q, CAST(dayofweek(order_date) + 1 AS INTEGER) AS dow,
       CAST(weekofyear(order_date) AS INTEGER) AS week FROM ord""",
)
def _(f):
    parts = dates.calendar_parts(
        "order_date", {"year": "y", "month": "m", "quarter": "q", "day_of_week": "dow", "iso_week": "week"}
    )
    return f.orders.select("order_id", *[c.alias(n) for n, c in parts.items()])


@query("dat_02_month_start", "SELECT order_id, make_date(year(order_date), month(order_date), 1) AS month_start FROM ord")
def _(f):
    return f.orders.select("order_id", dates.month_start("order_date").alias("month_start"))


@query("dat_03_week_start", "SELECT order_id, CAST(date_trunc('week', order_date) AS DATE) AS week_start FROM ord")
def _(f):
    return f.orders.select("order_id", dates.week_start("order_date").alias("week_start"))


@query("dat_04_day_differences", "SELECT purchase_id, days_late, lead_time_days FROM purch_c")
def _(f):
    return f.purchases_timed.select("purchase_id", "days_late", "lead_time_days")


@query(
    "dat_04_missing_dates",
    """SELECT order_id, CAST(actual_delivery - order_date AS INTEGER) AS days,
       CAST(coalesce(actual_delivery - order_date, 0) AS INTEGER) AS days_or_zero FROM ord""",
)
def _(f):
    return f.orders.select(
        "order_id",
        dates.days_between("actual_delivery", "order_date").alias("days"),
        dates.days_between("actual_delivery", "order_date", default=0).alias("days_or_zero"),
    )


@query("dat_05_run_stamp", "SELECT order_id, DATE '2024-12-31' AS scored_date FROM ord")
def _(f):
    return dates.stamp(f.orders.select("order_id"), "scored_date", F.lit("2024-12-31").cast("date"))


@query(
    "str_01_slug",
    """SELECT p_partkey, CASE WHEN s = '' THEN 'UNIT' ELSE s END AS slug, CASE WHEN c = '' THEN 'FACTORY' ELSE c END AS code,
       'ASIA_' || CASE WHEN s = '' THEN 'UNIT' ELSE s END AS factory_id
       FROM (SELECT p_partkey, trim(regexp_replace(upper(t), '[^A-Z0-9]+', '_', 'g'), '_') AS s,
             regexp_replace(upper(t), '[^A-Z0-9]', '', 'g') AS c
             FROM (SELECT p_partkey, ' ' || p_name || ' / ' || p_brand || '!' AS t FROM part) AS x) AS y""",
)
def _(f):
    name = F.concat(F.lit(" "), "p_name", F.lit(" / "), "p_brand", F.lit("!"))
    named = f.table("part").select("p_partkey", name.alias("t"))
    return named.select(
        "p_partkey", text.slug("t").alias("slug"), text.company_code("t").alias("code"),
        text.unit_id(F.lit("ASIA"), "t").alias("factory_id"),
    )


@query(
    "str_01_factory_rows",
    """SELECT n_name AS factory_name, company_id, n_name AS governorate,
       company_id || '_' || CASE WHEN n_nationkey % 2 = 0 THEN 'UNIT_' || n_nationkey ELSE replace(n_name, ' ', '_') END
       AS factory_id FROM places""",
)
def _(f):
    code = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("unit "), F.col("n_nationkey").cast("string"))).otherwise("")
    requests = f.places.select(
        "company_id", F.col("n_name").alias("factory_name"), F.col("n_name").alias("governorate"), code.alias("factory_code")
    )
    return directory.factory_rows(requests)


@query(
    "str_02_alert_text",
    """SELECT date, 'Steel price spike' AS title, 'high' AS severity, 'steel moved ' || CAST(price_change_pct AS VARCHAR)
       || '% on ' || CAST(date AS VARCHAR) || ' (now ? EGP).' AS detail FROM mkt_c WHERE is_price_spike = 1""",
)
def _(f):
    spikes = f.market_clean.filter("is_price_spike = 1").select(
        "date", "price_change_pct", F.lit("price_spike").alias("event_type"),
        F.lit(None).cast("double").alias("steel_price_egypt_egp"), F.lit(None).cast("string").alias("facility"),
        F.lit(None).cast("string").alias("production_line"), F.lit(None).cast("double").alias("avg_efficiency"),
    )
    return alerts.message(spikes).select("date", "title", "detail", "severity")


@query(
    "str_02_efficiency_text",
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'Factory efficiency below 70%'
       ELSE 'Alert: ' || event_type END AS title, 'warning' AS severity,
       CASE WHEN event_type IN ('view', 'click') THEN event_type || ' is running at ' || k || '%.' ELSE event_type END
       AS detail FROM ev""",
)
def _(f):
    kind = (
        F.when(F.col("event_type") == "view", "low_efficiency")
        .when(F.col("event_type") == "click", "line_efficiency_low")
        .otherwise(F.col("event_type"))
    )
    rows = f.events.select(
        "event_id", kind.alias("event_type"), F.col("event_type").alias("facility"),
        F.lit(None).cast("string").alias("production_line"), F.col("k").alias("avg_efficiency"),
        F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("price_change_pct"),
        F.lit(None).cast("double").alias("steel_price_egypt_egp"),
    )
    return alerts.message(rows).select("event_id", "title", "detail", "severity")


@query(
    "str_03_rows_to_json",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","k":' || k || '}' AS record
       FROM ev""",
)
def _(f):
    return f.events.select("event_id", text.row_json(["event_id", "event_type", "k"]).alias("record"))


@query("str_04_model_tag", "SELECT event_id, 'v1.1_' || event_type || '_delta' AS model_version FROM events")
def _(f):
    tag = text.model_tag("v1.1", F.col("event_type"), "_delta")
    return f.table("events").select("event_id", tag.alias("model_version"))


@query(
    "str_05_product_size",
    """SELECT batch_id, CASE WHEN product_type LIKE '%rebar%' THEN split_part(product_type, '_', 2) ELSE 'N/A' END
       AS product_size FROM prod""",
)
def _(f):
    return f.production.select("batch_id", text.product_size("product_type").alias("product_size"))
