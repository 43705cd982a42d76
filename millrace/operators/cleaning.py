"""Cleaned layer: one function per feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import dates, guards, series
from millrace.plans.joins import attach_market
from millrace.schemas import REGION_GOVERNORATES, TENANT_KEYS


@dataclass(frozen=True)
class Rates:
    """Used where the market has no row for the day."""

    electricity_egp_kwh: float = 3.5
    natural_gas_usd: float = 3.0
    usd_egp: float = 50.0


@dataclass(frozen=True)
class Limits:
    """Business thresholds."""

    spike_pct: float = 2.0
    low_efficiency_pct: float = 70.0
    large_order_tons: float = 100.0
    efficient_haul_egp_ton_km: float = 3.5
    shift_rank: dict = field(default_factory=lambda: {"morning": 1, "afternoon": 2, "night": 3})
    other_shift_rank: int = 4


RATES = Rates()
LIMITS = Limits()


def shift_rank(shift="shift", limits: Limits = LIMITS) -> Column:
    """Rank of the shift (SCL-06)."""
    ranks = F.create_map(*[F.lit(x) for pair in limits.shift_rank.items() for x in pair])
    known = F.try_element_at(ranks, guards.as_col(shift))
    return F.coalesce(known, F.lit(limits.other_shift_rank))


def region_of(governorate, groups: dict[str, list[str]] = REGION_GOVERNORATES, other: str = "Other") -> Column:
    """Sales region of a governorate (SCL-08); the mapping is a parameter."""
    lookup = F.create_map(*[F.lit(x) for region, names in groups.items() for name in names for x in (name, region)])
    return F.coalesce(F.try_element_at(lookup, guards.as_col(governorate)), F.lit(other))


def delivery_score(status="status", delay="delay_days") -> Column:
    """Points for punctuality (SCL-09). Bounds in days and their points."""
    steps = [(0, 100.0), (2, 80.0), (5, 60.0), (10, 40.0)]
    expr = F.when(guards.as_col(status) == "cancelled", 0.0)
    for bound, points in steps:
        expr = expr.when(guards.as_col(delay) <= bound, points)
    return expr.otherwise(20.0)


def underperforming(efficiency="efficiency_pct", limits: Limits = LIMITS) -> Column:
    return guards.flag(guards.as_col(efficiency) < limits.low_efficiency_pct)


def energy_cost(rates: Rates = RATES) -> Column:
    """Electricity plus gas at the market rates of the day (SCL-05)."""
    power = F.col("energy_kwh") * guards.or_else("electricity_price_egp_kwh", rates.electricity_egp_kwh)
    gas = (
        F.col("natural_gas_m3")
        * guards.or_else("natural_gas_price_usd", rates.natural_gas_usd)
        * guards.or_else("usd_egp_rate", rates.usd_egp)
    )
    return F.round(power + gas, 2)


def price_signals(
    df: DataFrame,
    price: str,
    *,
    date_col: str = "date",
    partition_by: list[str] | None = None,
    first_change: float | None = 0.0,
    spike_pct: float = LIMITS.spike_pct,
) -> DataFrame:
    """Daily change, 7- and 30-row means, 7-row deviation and spike flag of any price column."""
    over = series.series(partition_by, date_col)
    df = df.withColumns(
        {
            "price_change_pct": series.change_pct(price, over, first=first_change),
            "moving_avg_7d": series.moving_avg(price, over, 7),
            "moving_avg_30d": series.moving_avg(price, over, 30),
            "price_volatility_7d": series.rolling_std(price, over, 7),
        }
    )
    return df.withColumn("is_price_spike", guards.flag(F.abs("price_change_pct") > spike_pct))


def clean_market(df: DataFrame) -> DataFrame:
    """Market with signals per tenant and year and prices in local currency (PRJ-08, WIN-01..03).

    The series is made daily first: one row per tenant and date.
    """
    keys = [c for c in TENANT_KEYS if c in df.columns] + ["date"]
    daily = series.one_row_per_key(df.filter(F.col("date").isNotNull()), keys)
    dated = daily.withColumn("year", F.year("date"))
    signals = price_signals(dated, "steel_price_egypt_egp", partition_by=TENANT_KEYS + ["year"])
    return signals.withColumns(
        {
            "iron_ore_price_egp": guards.convert("iron_ore_price_usd", "usd_egp_rate"),
            "scrap_price_egp": guards.convert("scrap_price_usd", "usd_egp_rate"),
        }
    )


def clean_production(
    df: DataFrame, market: DataFrame, rates: Rates = RATES, limits: Limits = LIMITS
) -> DataFrame:
    """Batches with net output, per-ton ratios, energy cost and flags."""
    rate_cols = ["electricity_price_egp_kwh", "natural_gas_price_usd", "usd_egp_rate"]
    priced = attach_market(df, "date", market, {c: c for c in rate_cols})
    return priced.withColumns(
        {
            "net_output_tons": F.round(F.col("actual_tons") - F.col("waste_tons"), 2),
            "energy_per_ton": guards.safe_ratio("energy_kwh", "actual_tons"),
            "gas_per_ton": guards.safe_ratio("natural_gas_m3", "actual_tons"),
            "estimated_energy_cost_egp": energy_cost(rates),
            "shift_rank": shift_rank(limits=limits),
            "is_underperforming": underperforming(limits=limits),
        }
    ).drop(*rate_cols)


def clean_orders(
    df: DataFrame,
    market: DataFrame,
    regions: dict[str, list[str]] = REGION_GOVERNORATES,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Orders with market values of the day, region, size flag, delivery score and calendar parts."""
    priced = attach_market(
        df, "order_date", market,
        {"steel_price_egypt_egp": "steel_price_at_order", "usd_egp_rate": "usd_rate_at_order"},
    )
    return priced.withColumns(
        {
            "is_large_order": guards.flag(F.col("quantity_tons") >= limits.large_order_tons),
            "region": region_of("delivery_governorate", regions),
            "delivery_performance_score": delivery_score(),
            **dates.calendar_parts(
                "order_date",
                {"month": "order_month", "quarter": "order_quarter", "day_of_week": "order_day_of_week"},
            ),
        }
    )


def clean_shipments(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Shipments with per-ton ratios, transit days, speed and efficiency flag."""
    transit = dates.days_between("arrival_date", "departure_date")
    return df.withColumns(
        {
            "cost_per_ton": guards.safe_ratio("transport_cost_egp", "weight_tons"),
            "transit_days": transit,
            "delivery_speed_km_per_day": F.when(
                transit > 0, F.round(F.try_divide(F.col("distance_km"), transit), 2)
            ).otherwise(F.col("distance_km").cast("double")),
            "fuel_per_ton": guards.safe_ratio("fuel_liters", "weight_tons"),
            "co2_per_ton": guards.safe_ratio("co2_emissions_kg", "weight_tons"),
            "is_efficient": guards.flag(F.col("cost_per_ton_km_egp") <= limits.efficient_haul_egp_ton_km),
        }
    )


def purchase_delays(df: DataFrame) -> DataFrame:
    """Days late and lead time; 0 where a date is missing (DAT-04)."""
    return df.withColumns(
        {
            "days_late": dates.days_between("actual_delivery", "expected_delivery", default=0),
            "lead_time_days": dates.days_between("actual_delivery", "purchase_date", default=0),
        }
    )


def clean_purchases(df: DataFrame, market: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Raw-material purchases in local currency, with lateness and lead time."""
    priced = attach_market(df, "purchase_date", market, {"usd_egp_rate": "usd_rate_at_purchase"})
    to_egp = lambda c: guards.convert(c, "usd_rate_at_purchase", rates.usd_egp)
    return purchase_delays(priced).withColumns(
        {
            "total_landed_cost_egp": to_egp("total_landed_cost_usd"),
            "price_per_ton_egp": to_egp("price_per_ton_usd"),
        }
    )


def layer_statistics(
    df: DataFrame, name: str, flagged: Column | None = None, mean_of: str | None = None
) -> DataFrame:
    """Run statistics of a cleaned table in one pass (AGG-37)."""
    hit = F.count_if(flagged) if flagged is not None else F.lit(0).cast("bigint")
    mean = F.coalesce(F.avg(mean_of), F.lit(0.0)) if mean_of else F.lit(0.0)
    return df.agg(F.count(F.lit(1)).alias("total_rows"), hit.alias("flagged_rows"), mean.alias("mean_value")).select(
        F.lit(name).alias("table_name"),
        "total_rows",
        "flagged_rows",
        guards.safe_pct("flagged_rows", "total_rows").alias("flagged_pct"),
        "mean_value",
    )
