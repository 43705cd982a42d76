"""Queries behind dashboards and the tenant portal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import guards, series
from millrace.schemas import TENANT_KEYS

# -- headlines --------------------------------------------------------------------------------

KPI_SUMS = ["total_production_tons", "total_revenue_egp", "total_orders", "total_co2_kg", "profit_estimate_egp"]


def tenant_headline(kpis: DataFrame) -> DataFrame:
    """Null-safe totals of daily KPIs (AGG-24)."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return kpis.agg(
        *[zero(F.sum(c)).alias(c) for c in KPI_SUMS], zero(F.avg("avg_efficiency")).alias("avg_efficiency")
    )


def executive_row(kpis: DataFrame) -> DataFrame:
    """AGG-25."""
    return kpis.agg(
        F.sum("total_production_tons").alias("total_production"),
        F.avg("avg_efficiency").alias("avg_efficiency"),
        F.sum("total_revenue_egp").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.avg("on_time_delivery_pct").alias("on_time_pct"),
        F.sum("total_co2_kg").alias("total_co2"),
        F.sum("profit_estimate_egp").alias("total_profit"),
    )


def carrier_performance(shipments: DataFrame) -> DataFrame:
    """AGG-26."""
    return shipments.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("shipments"),
        guards.steady(F.avg("cost_per_ton"), 2).alias("avg_cost"),
        guards.steady(F.avg("transit_days"), 1).alias("avg_transit"),
        guards.steady(F.avg(F.when(F.col("delay_days") > 0, 1.0).otherwise(0.0)) * 100, 1).alias("delay_pct"),
        guards.steady(F.avg("co2_per_ton"), 1).alias("avg_co2"),
    ).orderBy(F.desc("shipments"), "carrier")


def mode_efficiency(shipments: DataFrame) -> DataFrame:
    """AGG-27."""
    return shipments.groupBy("transport_mode").agg(
        F.count(F.lit(1)).alias("shipments"),
        guards.steady(F.avg("co2_per_ton"), 1).alias("co2_per_ton"),
        guards.steady(F.avg("cost_per_ton"), 2).alias("cost_per_ton"),
        guards.steady(F.avg("transit_days"), 1).alias("transit"),
    ).orderBy(F.desc("shipments"), "transport_mode")


def active_orders(orders: DataFrame) -> DataFrame:
    """Orders that were not cancelled; a missing status is dropped too (PRJ-15)."""
    return orders.filter(F.col("status") != "cancelled")


def products_by_region(orders: DataFrame) -> DataFrame:
    """AGG-28."""
    return (
        active_orders(orders)
        .groupBy("region", "product_type")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("quantity_tons").alias("tons"))
        .orderBy("region", F.desc("tons"), "product_type")
    )


def customer_types(orders: DataFrame) -> DataFrame:
    """AGG-29."""
    return (
        active_orders(orders)
        .groupBy("customer_type")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_value_egp").alias("revenue"))
        .orderBy(F.desc("revenue"), "customer_type")
    )


def forecast_totals(forecasts: DataFrame) -> DataFrame:
    """AGG-30."""
    return (
        forecasts.groupBy("product_type")
        .agg(
            F.sum("actual_quantity_tons").alias("actual"), F.sum("predicted_quantity_tons").alias("predicted")
        )
        .orderBy(F.desc("actual"), "product_type")
    )


def output_by_facility(lines: DataFrame) -> DataFrame:
    """AGG-31."""
    return lines.groupBy("facility").agg(F.sum("total_output_tons").alias("total"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlations of every pair, from one pass, as (row, column, value) (AGG-32)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    flat = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    index = {p: f"c{i}" for i, p in enumerate(pairs)}
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("series_a"), F.lit(b).alias("series_b"), F.col(index.get((a, b)) or index[(b, a)]).alias("corr"))
            for a in cols
            for b in cols
        ]
    )
    return flat.select(F.inline(cells))


def with_share(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Share of the total in percent, the total as a scalar subquery (AGG-34)."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value), total) * 100)


def hierarchy(df: DataFrame, parent: str, child: str, value: str) -> DataFrame:
    """Totals of children, parents and everything, with the level (AGG-35)."""
    return df.rollup(parent, child).agg(
        F.sum(value).alias(value), F.grouping_id().cast("int").alias("level")
    )


def headline_of(df: DataFrame, means: list[str], sums: list[str]) -> DataFrame:
    """Count, means and sums of a mart (AGG-36)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(c).alias(f"avg_{c}") for c in means],
        *[F.sum(c).alias(f"sum_{c}") for c in sums],
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row-count inventory (SET-01)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -- carbon -----------------------------------------------------------------------------------


def co2_by_month(monthly: DataFrame) -> DataFrame:
    """One row per month over all tenants; the calendar bounds what follows."""
    return monthly.groupBy("month_start").agg(F.sum("total_co2_kg").alias("total_co2_kg"))


def co2_trend(months: DataFrame) -> DataFrame:
    """WIN-15."""
    over = series.series(None, "month_start")
    return months.withColumn("co2_ma3", series.full_rolling_mean("total_co2_kg", over, 3))


def mean_change(df: DataFrame, order_by: str, value: str, name: str = "trend_pct") -> DataFrame:
    """Mean relative change between neighbouring rows, in percent (WIN-16)."""
    before = series.previous(value, series.series(None, order_by))
    return df.select(F.try_divide(F.col(value) - before, before).alias("c")).agg((F.avg("c") * 100).alias(name))


def co2_totals(months: DataFrame) -> DataFrame:
    """Total and mean per month, over the months that exist (AGG-33)."""
    return months.agg(
        F.sum("total_co2_kg").alias("total_co2_kg"),
        F.avg("total_co2_kg").alias("monthly_mean_kg"),
        F.count(F.lit(1)).alias("months"),
    )


# -- series -----------------------------------------------------------------------------------


def latest_change(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """Latest value, the one before and the change (WIN-17): a top-2, not a sorted table."""
    newest = df.groupBy(date_col).agg(F.max(value).alias(value)).orderBy(F.desc(date_col)).limit(2)
    both = newest.agg(
        F.max(date_col).alias(date_col),
        F.max_by(value, date_col).alias("latest"),
        F.when(F.count(F.lit(1)) > 1, F.min_by(value, date_col)).alias("previous"),
    )
    change = F.try_divide(F.col("latest") - F.col("previous"), F.col("previous")) * 100
    return both.withColumn("change_pct", change)


def recent_days(df: DataFrame, n: int, date_col: str = "date", tie: list[str] | None = None) -> DataFrame:
    """Most recent ``n`` rows in date order (TOP-05)."""
    tie = tie or []
    return df.orderBy(F.desc(date_col), *tie).limit(n).orderBy(date_col, *tie)


def price_alert_rows(market: DataFrame, limit: int = 20) -> DataFrame:
    """The most recent price spikes (TOP-07)."""
    if limit < 1:
        raise ValueError("limit must be positive")
    return (
        market.filter("is_price_spike = 1")
        .select("date", "steel_price_egypt_egp", "price_change_pct")
        .orderBy(F.desc("date"))
        .limit(limit)
    )


def shift_against_line(shift_efficiency: DataFrame) -> DataFrame:
    """Shift means beside the mean of the line's shifts (WIN-14)."""
    w = Window.partitionBy(*TENANT_KEYS, "production_line")
    return shift_efficiency.withColumn("line_avg", F.avg("avg_eff_shift").over(w))


def chart_projection(market: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric columns for charts (PRJ-16)."""
    return market.select("date", *[F.col(c).cast("double").alias(c) for c in cols], "is_price_spike")


# -- display bands (SCL-26). Cut points and colours ------------------------------


def portal_risk_band(score="risk_score") -> Column:
    return guards.band(score, [(50, "red"), (25, "amber")], "green", inclusive=True)


def portal_efficiency_band(value="avg_efficiency") -> Column:
    return guards.band(value, [(70, "red"), (85, "amber")], "green", above=False)


def chart_risk_band(score="risk_score") -> Column:
    return guards.band(score, [(34, "green"), (37, "amber")], "red", above=False)


def chart_efficiency_band(value="avg_efficiency") -> Column:
    return guards.band(value, [(85, "green"), (80, "amber")], "red")
