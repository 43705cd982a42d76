"""Marts from states that merge: one state per key and day, added to as rows arrive, in any order and however late.

A state holds numbers only from which any union of its rows can be had: counts, sums with the number of values
in them, and number, mean and squared deviations of what needs a sample deviation. Deviations are merged around the
common mean, not as differences of squares, so large means cost no digits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions import guards
from millrace.operators.marts import CANCELLED_SPELLINGS, SCORECARD_KEYS, kpi_star, leaders_of, monthly_totals, with_leaders
from millrace.schemas import TENANT_KEYS
from millrace.sinks import snapshots


@dataclass(frozen=True)
class Measures:
    """What a state keeps: ``counts`` are aggregates that add up, the others are values of a row."""

    counts: dict[str, Column] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)
    spreads: dict[str, Column] = field(default_factory=dict)


def state_of(df: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """States of the rows: one pass with map-side combine."""
    parts = [c.alias(name) for name, c in measures.counts.items()]
    for name, c in measures.sums.items():
        parts += [F.count(c).alias(f"{name}_n"), F.sum(c.cast("double")).alias(f"{name}_sum")]
    for name, c in measures.spreads.items():
        parts += [
            F.count(c).alias(f"{name}_n"), F.avg(c.cast("double")).alias(f"{name}_mean"),
            (F.var_pop(c.cast("double")) * F.count(c)).alias(f"{name}_dev"),
        ]
    return df.groupBy(*keys).agg(*parts)


def merged(states: DataFrame, keys: list[str], measures: Measures, few: bool = False) -> DataFrame:
    """States of the same keys as one, or of fewer keys: the days of a key, say.

    The common means come first; they meet the states again by the keys, so no group is held in one place. If the states
    of a key are ``few``, those of some batches, they meet in a window instead: all are shuffled once and joined with nothing.
    """
    adding = [*measures.counts, *[f"{n}_{p}" for n in measures.sums for p in ("n", "sum")], *[f"{n}_n" for n in measures.spreads]]
    weighted = [F.try_divide(F.sum(F.col(f"{n}_mean") * F.col(f"{n}_n")), F.sum(f"{n}_n")).alias(f"{n}_mean") for n in measures.spreads]
    summed = [F.sum(c).alias(c) for c in adding]
    if few and measures.spreads:
        of_key = Window.partitionBy(*keys)
        mean = lambda n: F.try_divide(F.sum(F.col(f"{n}_mean") * F.col(f"{n}_n")).over(of_key), F.sum(f"{n}_n").over(of_key))
        near = states.withColumns({f"{n}_mean_of_key": mean(n) for n in measures.spreads})
        around = lambda n: F.col(f"{n}_dev") + F.col(f"{n}_n") * F.pow(F.col(f"{n}_mean") - F.col(f"{n}_mean_of_key"), F.lit(2))
        return near.groupBy(*keys).agg(*summed, *weighted, *[F.sum(around(n)).alias(f"{n}_dev") for n in measures.spreads])
    total = states.groupBy(*keys).agg(*summed, *weighted)
    if not measures.spreads:
        return total
    # Null keys are keys as well, so they are compared as such.
    a, b = states.alias("a"), total.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    apart = [
        (F.col(f"a.{n}_dev") + F.col(f"a.{n}_n") * F.pow(F.col(f"a.{n}_mean") - F.col(f"b.{n}_mean"), F.lit(2))).alias(f"{n}_dev")
        for n in measures.spreads
    ]
    spread = a.join(b, same).select(*[F.col(f"a.{k}").alias(k) for k in keys], *apart)
    devs = spread.groupBy(*keys).agg(*[F.sum(f"{n}_dev").alias(f"{n}_dev") for n in measures.spreads]).alias("d")
    t = total.alias("t")
    met = t.join(devs, [F.col(f"t.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys])
    return met.select("t.*", *[F.col(f"d.{n}_dev") for n in measures.spreads])


def mean_of(name: str, part: str = "sum") -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")) if part == "sum" else F.col(f"{name}_mean")


def deviation(name: str) -> Column:
    """Sample deviation, null for fewer than two values."""
    return F.when(F.col(f"{name}_n") > 1, F.sqrt(F.col(f"{name}_dev") / (F.col(f"{name}_n") - 1)))


def supplier_measures() -> Measures:
    """What the supplier scorecard needs (AGG-05)."""
    return Measures(
        counts={"total_purchases": F.count("purchase_id"), "on_time": F.count_if(F.col("on_time").cast("int") == 1)},
        sums={"quantity": F.col("quantity_tons"), "lead": F.col("lead_time_days"), "reliability": F.col("supplier_reliability")},
        spreads={"price": F.col("price_per_ton_usd")},
    )


def supplier_totals(states: DataFrame) -> DataFrame:
    """AGG-05 from states of any number of days."""
    return merged(states, SCORECARD_KEYS, supplier_measures()).select(
        *SCORECARD_KEYS,
        "total_purchases",
        F.when(F.col("quantity_n") > 0, F.col("quantity_sum")).alias("total_quantity_tons"),
        mean_of("price", "mean").alias("avg_price_per_ton_usd"),
        mean_of("lead").alias("avg_lead_time_days"),
        guards.share_pct(F.col("on_time"), F.col("total_purchases")).alias("on_time_pct"),
        mean_of("reliability").alias("avg_reliability"),
        deviation("price").alias("price_volatility"),
    )


@dataclass(frozen=True)
class States:
    """States of one fact in a versioned table. Added rows cost their own days only: nothing else is read or written.

    A number given with a batch makes its replay harmless. Rows that change later are no additions; they need their
    days built again.
    """

    keys: list[str]
    measures: Measures

    def add(self, rows: DataFrame, path: str, batch: int | None = None) -> None:
        new = state_of(rows, self.keys, self.measures)
        if snapshots.snapshot(rows.sparkSession, path) is None:
            snapshots.replace_all(new, path, self.keys[:2], batch=batch)
        else:
            snapshots.append_rows(new, path, batch=batch)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """One state per key."""
        return merged(snapshots.read_snapshot(spark, path), self.keys, self.measures, few=True)

    def compact(self, spark: SparkSession, path: str) -> None:
        """One state per key again, in one commit."""
        snapshots.replace_all(self.read(spark, path), path, self.keys[:2])


def supplier_states() -> States:
    return States([*SCORECARD_KEYS, "purchase_date"], supplier_measures())


def add_purchases(purchases: DataFrame, path: str, batch: int | None = None) -> None:
    """Add rows to the states of suppliers and days kept in a versioned table."""
    supplier_states().add(purchases, path, batch)


def compact_purchases(spark: SparkSession, path: str) -> None:
    """One state per supplier and day again, in one commit."""
    supplier_states().compact(spark, path)


# -- KPI star ---------------------------------------------------------------------------------

DAY_KEYS = [*TENANT_KEYS, "date"]
CUBE_KEYS = [*TENANT_KEYS, "year_val", "month_val", "product_type", "delivery_governorate"]


def production_states(low_pct: float = 70.0) -> States:
    """Tenant-days of production (AGG-01)."""
    return States(DAY_KEYS, Measures(
        counts={"underperforming_batches": F.count_if(F.col("efficiency_pct") < low_pct)},
        sums={"actual": F.col("actual_tons"), "efficiency": F.col("efficiency_pct"), "waste": F.col("waste_tons"), "energy": F.col("energy_kwh")},
    ))


def production_days(states: DataFrame) -> DataFrame:
    """AGG-01 from one state per tenant-day."""
    return states.select(
        *DAY_KEYS, F.col("actual_sum").alias("total_production_tons"), mean_of("efficiency").alias("avg_efficiency"),
        F.col("waste_sum").alias("total_waste_tons"), F.col("energy_sum").alias("total_energy_kwh"), "underperforming_batches",
    )


def order_states() -> States:
    """Tenant-days of orders (AGG-02); the rows carry their day as ``date``."""
    return States(DAY_KEYS, Measures(
        counts={
            "total_orders": F.count("order_id"), "delivered": F.count_if(F.col("status") == "delivered"),
            "cancelled_orders_daily": F.count_if(F.col("status").isin(CANCELLED_SPELLINGS)),
        },
        sums={"quantity": F.col("quantity_tons"), "value": F.col("total_value_egp")},
    ))


def order_days(states: DataFrame) -> DataFrame:
    """AGG-02 from one state per tenant-day."""
    return states.select(
        *DAY_KEYS, "total_orders", F.col("quantity_sum").alias("total_order_tons"), F.col("value_sum").alias("total_revenue_egp"),
        mean_of("quantity").alias("avg_order_size_tons"),
        guards.share_pct(F.col("delivered"), F.col("total_orders")).alias("on_time_delivery_pct"), "cancelled_orders_daily",
    )


def shipment_states() -> States:
    """Tenant-days of shipments (AGG-03); the rows carry their day as ``date``."""
    return States(DAY_KEYS, Measures(
        counts={"total_shipments": F.count("shipment_id")},
        sums={"cost": F.col("transport_cost_egp"), "co2": F.col("co2_emissions_kg"), "fuel": F.col("fuel_liters"), "unit": F.col("cost_per_ton_km_egp")},
    ))


def shipment_days(states: DataFrame) -> DataFrame:
    """AGG-03 from one state per tenant-day."""
    return states.select(
        *DAY_KEYS, "total_shipments", F.col("cost_sum").alias("total_logistics_cost_egp"), F.col("co2_sum").alias("total_co2_kg"),
        F.col("fuel_sum").alias("total_fuel_liters"), mean_of("unit").alias("avg_cost_per_ton_km"),
    )


def cube_states() -> States:
    """Orders and revenue of tenant-months by product and governorate, for the monthly leaders (WIN-08)."""
    return States(CUBE_KEYS, Measures(counts={"n": F.count(F.lit(1))}, sums={"revenue": F.col("total_value_egp")}))


@dataclass(frozen=True)
class KpiStates:
    """The states behind the daily star and the monthly summary, a table each below one folder."""

    path: str

    def add(
        self, production: DataFrame | None = None, orders: DataFrame | None = None, shipments: DataFrame | None = None,
        batch: int | None = None,
    ) -> None:
        """Add new or late rows. A batch that died between two tables is given again under its number: each table
        takes what it has not taken yet."""
        if production is not None:
            production_states().add(production, f"{self.path}/production", batch)
        if orders is not None:
            dated = orders.withColumn("date", F.col("order_date"))
            order_states().add(dated, f"{self.path}/orders", batch)
            months = dated.withColumns({"year_val": F.year("date"), "month_val": F.month("date")})
            cube_states().add(months, f"{self.path}/order_cube", batch)
        if shipments is not None:
            shipment_states().add(shipments.withColumn("date", F.col("departure_date")), f"{self.path}/shipments", batch)

    def compact(self, spark: SparkSession) -> None:
        for kind, name in self._tables():
            kind.compact(spark, f"{self.path}/{name}")

    @staticmethod
    def _tables() -> list[tuple[States, str]]:
        return [(production_states(), "production"), (order_states(), "orders"), (shipment_states(), "shipments"), (cube_states(), "order_cube")]

    def days(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        """AGG-01, AGG-02 and AGG-03."""
        made = (production_days, order_days, shipment_days)
        return tuple(make(kind.read(spark, f"{self.path}/{name}")) for make, (kind, name) in zip(made, self._tables()))

    def daily(self, market: DataFrame) -> DataFrame:
        """JN-02: the star reads states of tenant-days, no fact rows."""
        return kpi_star(*self.days(market.sparkSession), market)

    def monthly(self, market: DataFrame) -> DataFrame:
        """AGG-04 and JN-03."""
        cube = cube_states().read(market.sparkSession, f"{self.path}/order_cube")
        leaders = leaders_of(cube.select(*CUBE_KEYS, "n", F.col("revenue_sum").alias("revenue")))
        return with_leaders(monthly_totals(self.daily(market)), leaders)
