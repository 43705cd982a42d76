"""Test tables seen as the five feeds. Every feed is a projection of the given tables, so the work
of each query grows with them. But for lines and orders the joins carry no hints: small dimensions are broadcast by
their file size, large ones are shuffled and adaptive execution splits skewed keys."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators import cleaning, marts
from millrace.session import staged
from millrace.tenancy import Tenant

# Governorate groups of the test data; nations 20-24 stay unmapped.
TEST_REGIONS = {
    name: [f"NATION_{k}" for k in range(start, start + 5)]
    for name, start in [("North", 0), ("South", 5), ("East", 10), ("West", 15)]
}
TEST_TENANT = Tenant("ASIA", "ASIA_0")
TEST_COMPANY = Tenant("ASIA", "ALL_FACTORIES")
STREAM_BASELINE = 50.0


def wrapped(days: Column, span: int = 15) -> Column:
    return F.pmod(days, F.lit(span))


class Feeds:
    """Lazily built feeds, cleaned tables and marts of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions ---------------------------------------------------------------------------

    @cached_property
    def places(self) -> DataFrame:
        """Nation with its tenant: the region is the company, two factories each."""
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey",
            "n_name",
            F.col("r_name").alias("company_id"),
            F.concat_ws("_", "r_name", (F.col("n_nationkey") % 2).cast("string")).alias("factory_id"),
        )

    @cached_property
    def line_days(self) -> DataFrame:
        """Lines with the day and customer of their order. Days are made ahead of the join: they shuffle smaller than times.

        The orders of a partition are hashed, a row each, so its lines, several times as many, need no sort.
        """
        lines = self.table("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
        heads = self.table("orders").select(
            "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day")
        )
        return lines.join(heads.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))

    @staticmethod
    def line_id() -> Column:
        return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    # -- raw feeds ----------------------------------------------------------------------------

    @cached_property
    def market(self) -> DataFrame:
        """One row per day, staged: most queries read it several times, and all lines are behind it."""
        parts = self.table("part").select("p_partkey", "p_retailprice", "p_size")
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        nine = lambda c: F.round(c, 9)
        daily = (
            self.line_days.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("order_day").alias("date"))
            .agg(
                nine(F.avg(unit)).alias("steel_price_egypt_egp"),
                nine(F.avg("p_retailprice")).alias("iron_ore_price_usd"),
                nine(F.avg("p_size")).alias("scrap_price_usd"),
                nine(F.avg("l_tax") + 1).alias("usd_egp_rate"),
                nine(F.avg("l_quantity")).alias("natural_gas_price_usd"),
                nine(F.max(unit) / 1001).alias("brent_oil_usd"),
                nine(F.avg("l_discount") + 1).alias("electricity_price_egp_kwh"),
                nine(F.avg("l_tax")).alias("seasonality_index"),
            )
            .withColumns(
                {
                    "is_ramadan": (F.month("date") == 3).cast("int"),
                    "company_id": F.lit("MARKET"),
                    "factory_id": F.lit("ALL_FACTORIES"),
                }
            )
        )
        return staged(daily, "market")

    @cached_property
    def production(self) -> DataFrame:
        suppliers = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        actual = F.greatest(F.col("l_quantity") - 2, F.lit(0.0))
        discount = F.abs("l_discount")
        return (
            self.table("lineitem")
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                "company_id",
                "factory_id",
                self.line_id().alias("batch_id"),
                F.to_date("l_shipdate").alias("date"),
                F.col("n_name").alias("facility"),
                F.col("s_name").alias("production_line"),
                F.col("l_linestatus").alias("line_type"),
                F.when(
                    F.col("l_linestatus") == "O",
                    F.concat(F.lit("rebar_"), (F.col("l_linenumber") * 2 + 6).cast("string"), F.lit("mm")),
                )
                .otherwise("coil")
                .alias("product_type"),
                F.when(F.col("l_returnflag") == "A", "morning")
                .when(F.col("l_returnflag") == "N", "afternoon")
                .otherwise("night")
                .alias("shift"),
                F.lit(45.0).alias("planned_tons"),
                actual.alias("actual_tons"),
                (actual * discount).alias("waste_tons"),
                (discount * 100).alias("yield_loss_pct"),
                (F.col("l_quantity") / 45 * 100).alias("efficiency_pct"),
                (F.col("l_extendedprice") / 100).alias("energy_kwh"),
                (F.col("l_extendedprice") / 1000).alias("natural_gas_m3"),
                (F.lit(10.0) - F.col("l_tax") * 50).alias("quality_score"),
                F.when(F.col("l_quantity") <= 2, "maintenance").otherwise("running").alias("status"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        per_order = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum("l_quantity").alias("quantity_tons"), F.min("l_shipdate").alias("first_ship"))
        )
        customers = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        day = F.to_date("o_orderdate")
        delay = wrapped(F.datediff(F.to_date("first_ship"), day)) - 2
        return (
            self.table("orders")
            .join(per_order, "o_orderkey", "left")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "company_id",
                "factory_id",
                F.col("o_orderkey").cast("string").alias("order_id"),
                day.alias("order_date"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                F.col("c_mktsegment").alias("customer_type"),
                F.col("o_orderpriority").alias("product_type"),
                "quantity_tons",
                F.try_divide("o_totalprice", "quantity_tons").alias("price_per_ton_egp"),
                F.col("o_totalprice").alias("total_value_egp"),
                F.col("n_name").alias("delivery_governorate"),
                F.date_add(day, 7).alias("expected_delivery"),
                F.date_add(day, F.lit(7) + delay).alias("actual_delivery"),
                delay.alias("delay_days"),
                (delay > 0).cast("int").alias("is_delayed"),
                F.when(F.col("o_orderstatus") == "F", "delivered")
                .when(F.col("o_orderstatus") == "O", "pending")
                .otherwise("cancelled")
                .alias("status"),
            )
        )

    @cached_property
    def shipments(self) -> DataFrame:
        parts = self.table("part").select("p_partkey", "p_size")
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        transit = wrapped(F.datediff(F.to_date("l_shipdate"), F.col("order_day")))
        distance = F.col("p_size") * 20
        cost = F.col("l_extendedprice") / 10
        trucks = F.ceil(F.col("l_quantity") / 25).cast("int")
        fuel = distance * trucks * 0.35
        return (
            self.line_days.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "company_id",
                "factory_id",
                self.line_id().alias("shipment_id"),
                F.col("l_orderkey").cast("string").alias("order_id"),
                F.col("factory_id").alias("origin"),
                F.col("n_name").alias("destination"),
                distance.alias("distance_km"),
                F.when(F.col("l_linestatus") == "F", "truck").otherwise("rail").alias("transport_mode"),
                trucks.alias("num_trucks"),
                F.col("l_quantity").alias("weight_tons"),
                cost.alias("transport_cost_egp"),
                (cost / (distance * F.col("l_quantity"))).alias("cost_per_ton_km_egp"),
                fuel.alias("fuel_liters"),
                (fuel * 2.68).alias("co2_emissions_kg"),
                F.col("order_day").alias("departure_date"),
                F.date_add("order_day", transit).alias("arrival_date"),
                (transit - 4).alias("delay_days"),
                F.lit("delivered").alias("status"),
                F.concat(F.lit("CARRIER_"), (F.col("l_suppkey") % 8).cast("string")).alias("carrier"),
            )
        )

    @cached_property
    def purchases(self) -> DataFrame:
        parts = self.table("part").select("p_partkey", "p_size", "p_type")
        suppliers = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        lead = wrapped(F.datediff(F.to_date("l_shipdate"), F.col("order_day")))
        price = F.lit(100.0) + F.col("p_size") * (F.col("s_nationkey") % 4)
        freight = F.col("l_tax") * 100
        qty = F.col("l_quantity")
        return (
            self.line_days.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                "company_id",
                "factory_id",
                self.line_id().alias("purchase_id"),
                F.col("p_type").alias("material_type"),
                F.col("s_name").alias("supplier_name"),
                F.col("n_name").alias("origin_country"),
                qty.alias("quantity_tons"),
                price.alias("price_per_ton_usd"),
                freight.alias("ocean_freight_usd_per_ton"),
                (qty * (price + freight)).alias("total_landed_cost_usd"),
                F.col("order_day").alias("purchase_date"),
                F.date_add("order_day", 7).alias("expected_delivery"),
                F.date_add("order_day", lead).alias("actual_delivery"),
                F.when(F.col("l_returnflag") == "A", "A")
                .when(F.col("l_returnflag") == "N", "B")
                .otherwise("C")
                .alias("quality_grade"),
                (lead <= 7).cast("int").alias("on_time"),
                (F.lit(1.0) - F.abs("l_discount")).alias("supplier_reliability"),
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        """Events with the payload counter decoded."""
        return self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    # -- cleaned layer ------------------------------------------------------------------------

    @cached_property
    def market_clean(self) -> DataFrame:
        return cleaning.clean_market(self.market)

    @cached_property
    def production_clean(self) -> DataFrame:
        return cleaning.clean_production(self.production, self.market)

    @cached_property
    def orders_clean(self) -> DataFrame:
        return cleaning.clean_orders(self.orders, self.market, TEST_REGIONS)

    @cached_property
    def orders_regional(self) -> DataFrame:
        """Orders with their region only, for marts that need no market value."""
        return self.orders.withColumn("region", cleaning.region_of("delivery_governorate", TEST_REGIONS))

    @cached_property
    def shipments_clean(self) -> DataFrame:
        return cleaning.clean_shipments(self.shipments)

    @cached_property
    def purchases_clean(self) -> DataFrame:
        return cleaning.clean_purchases(self.purchases, self.market)

    @cached_property
    def purchases_timed(self) -> DataFrame:
        """Purchases with their delays only, for work that needs no market value."""
        return cleaning.purchase_delays(self.purchases)

    def purchases_stored(self, *cols: str | Column, by: list[str] | None = None) -> DataFrame:
        """Columns of the timed purchases, staged for work that reads them more than once: all lines are joined behind
        them, and their columns are short once stored. A reader of one value of ``by`` opens its files only."""
        return staged(self.purchases_timed.select(*cols), "purchases", by)

    @cached_property
    def deliveries(self) -> DataFrame:
        """What the risk of suppliers is made from: the means of the groups and the rows both read it."""
        return self.purchases_stored(
            "supplier_name", "origin_country", "material_type", "price_per_ton_usd", "quality_grade", "on_time",
            "days_late", "lead_time_days", "supplier_reliability",
        )

    @cached_property
    def production_flagged(self) -> DataFrame:
        """Batches with their flag and net output only, likewise."""
        return self.production.withColumns(
            {
                "is_underperforming": cleaning.underperforming(),
                "net_output_tons": F.round(F.col("actual_tons") - F.col("waste_tons"), 2),
            }
        )

    # -- marts --------------------------------------------------------------------------------

    @cached_property
    def daily_kpis(self) -> DataFrame:
        return marts.daily_kpis(self.production, self.orders, self.shipments, self.market)

    @cached_property
    def monthly_summary(self) -> DataFrame:
        return marts.monthly_summary(self.daily_kpis, self.orders)

    @cached_property
    def supplier_scorecard(self) -> DataFrame:
        return marts.supplier_scorecard(self.purchases_timed)

    @cached_property
    def regional_demand(self) -> DataFrame:
        return marts.regional_demand(self.orders_regional, self.shipments)

    @cached_property
    def line_efficiency(self) -> DataFrame:
        return marts.line_efficiency(self.production)

    @cached_property
    def price_features(self) -> DataFrame:
        return marts.price_features(self.market_clean)
