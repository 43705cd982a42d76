"""The four monitors. Each is a stateless transform that runs on a batch table and on a stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import guards, series

# Price baseline, large order size in a stream, quality and efficiency floors.
PRICE_BASELINE_EGP = 42000.0
LARGE_ORDER_TONS = 1000.0
LOW_EFFICIENCY_PCT = 70.0
LOW_QUALITY = 7.0
PRICE_LEVELS = [(15, "CRITICAL"), (10, "HIGH"), (5, "MEDIUM")]


def baseline_change(price, baseline: float = PRICE_BASELINE_EGP) -> Column:
    return F.round((guards.as_col(price) - baseline) / baseline * 100, 2)


def price_level(change) -> Column:
    """SCL-23."""
    return guards.band(F.abs(guards.as_col(change)), PRICE_LEVELS, "LOW")


def production_alert(status, efficiency, quality) -> Column:
    """First matching condition (SCL-24)."""
    return (
        F.when(guards.as_col(status) == "power_outage", "POWER_OUTAGE")
        .when(guards.as_col(status) == "maintenance", "MAINTENANCE")
        .when(guards.as_col(efficiency) < LOW_EFFICIENCY_PCT, "LOW_EFFICIENCY")
        .when(guards.as_col(quality) < LOW_QUALITY, "LOW_QUALITY")
        .otherwise("NORMAL")
    )


def delayed(days) -> Column:
    """True for a positive delay, false otherwise and when unknown (SCL-25)."""
    return F.coalesce(guards.as_col(days) > 0, F.lit(False))


def leading_product(product, quantity, default: str = "unknown") -> Column:
    """Aggregate over per-product totals: the largest, or the default for none (TOP-03)."""
    return F.coalesce(series.top_label(product, quantity), F.lit(default))


def price_alerts(market: DataFrame, baseline: float = PRICE_BASELINE_EGP) -> DataFrame:
    """STM-01."""
    change = F.col("change_pct")
    return (
        market.select(
            guards.to_time("event_timestamp").alias("alert_time"),
            F.lit("steel_price_egp").alias("price_type"),
            guards.to_number("steel_price_egypt_egp").alias("current_price"),
            F.lit(float(baseline)).alias("previous_price"),
        )
        .withColumn("change_pct", baseline_change("current_price", baseline))
        .withColumn("alert_level", price_level(change))
    )


def order_summary(orders: DataFrame) -> DataFrame:
    """STM-02: one row for the frame given, which in a stream is one micro-batch.

    Per-product partial sums give the totals and the leading product in one pass.
    """
    qty, revenue = guards.to_number("quantity_tons"), guards.to_number("total_value_egp")
    per_product = orders.groupBy("product_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(qty).alias("qty"),
        F.sum(revenue).alias("revenue"),
        F.count_if(qty >= LARGE_ORDER_TONS).alias("large"),
    )
    return per_product.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"),
        F.round(F.sum("qty"), 2).alias("total_quantity_tons"),
        F.round(F.sum("revenue"), 2).alias("total_revenue_egp"),
        F.coalesce(F.sum("large"), F.lit(0)).alias("large_orders"),
        leading_product("product_type", F.round("qty", 6)).alias("top_product"),
    )


def order_windows(orders: DataFrame, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Event-time variant of the order summary: real windows, with a watermark on streams."""
    timed = orders.withColumn("_t", guards.to_time("event_timestamp")).filter(F.col("_t").isNotNull())
    if orders.isStreaming:
        timed = timed.withWatermark("_t", lateness)
    qty, revenue = guards.to_number("quantity_tons"), guards.to_number("total_value_egp")
    return (
        timed.groupBy(F.window("_t", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.round(F.sum(qty), 2).alias("total_quantity_tons"),
            F.round(F.sum(revenue), 2).alias("total_revenue_egp"),
            F.count_if(qty >= LARGE_ORDER_TONS).alias("large_orders"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_orders",
                "total_quantity_tons", "total_revenue_egp", "large_orders")
    )


def production_live(production: DataFrame) -> DataFrame:
    """STM-03."""
    return production.select(
        guards.to_time("event_timestamp").alias("event_time"),
        "facility",
        "production_line",
        guards.to_number("actual_tons").alias("actual_tons"),
        guards.to_number("efficiency_pct").alias("efficiency_pct"),
        guards.to_number("quality_score").alias("quality_score"),
        "status",
    ).withColumn("alert", production_alert("status", "efficiency_pct", "quality_score")).drop("status")


def shipment_status(shipments: DataFrame) -> DataFrame:
    """STM-04."""
    return shipments.select(
        guards.to_time("event_timestamp").alias("event_time"),
        "shipment_id",
        "origin",
        "destination",
        "status",
        guards.to_whole("delay_days").alias("delay_days"),
    ).withColumn("is_delayed", delayed("delay_days"))


MONITORS = {
    "market": price_alerts,
    "orders": order_summary,
    "production": production_live,
    "shipments": shipment_status,
}
# Stateless monitors append row by row; the order summary is per micro-batch.
PER_BATCH = {"orders"}
