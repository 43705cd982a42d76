"""Marts against plain Python on small frames."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators import marts, quality, served


def test_freight_weighting_equals_the_plain_join(spark, rows):
    """The weighted demand mart must equal grouping the full order-shipment fan-out."""
    orders = rows(
        [
            ("A", "A1", "o1", date(2024, 1, 2), "p2", "c1", 10.0, 100.0, 3, "Cairo", "R"),
            ("A", "A1", "o2", date(2024, 1, 1), "p1", "c2", 30.0, 300.0, 0, "Cairo", "R"),
            ("A", "A1", "o2", date(2024, 1, 1), "p1", "c2", 5.0, 50.0, None, "Cairo", "R"),
            ("A", "A1", "o3", date(2024, 1, 3), "p1", "c2", None, 70.0, 1, "Giza", "R"),
            ("B", "B1", "o1", date(2024, 1, 1), "p9", "c9", 1.0, 1.0, 9, "Cairo", "R"),
        ],
        "company_id string, factory_id string, order_id string, order_date date, product_type string,"
        "customer_type string, quantity_tons double, total_value_egp double, delay_days int,"
        "delivery_governorate string, region string",
    )
    shipments = rows(
        [("A", "A1", "o1", 7.0), ("A", "A1", "o1", 9.0), ("A", "A1", "o1", None), ("A", "A1", "o2", 1.0)],
        "company_id string, factory_id string, order_id string, transport_cost_egp double",
    )
    keys = ["company_id", "factory_id", "delivery_governorate"]
    plain = (
        orders.join(shipments, ["company_id", "factory_id", "order_id"], "left")
        .groupBy(*keys)
        .agg(
            F.count_distinct("order_id").alias("orders"), F.sum("quantity_tons").alias("tons"),
            F.avg("quantity_tons").alias("size"), F.avg("delay_days").alias("days"),
            F.round(F.count_if(F.col("delay_days") > 0) / F.count_distinct("order_id") * 100, 2).alias("late"),
            F.avg("transport_cost_egp").alias("cost"), F.sum("total_value_egp").alias("value"),
        )
    )
    want = {tuple(r[:3]): tuple(r[3:]) for r in plain.collect()}
    got = {
        (r.company_id, r.factory_id, r.governorate): (
            r.total_orders, r.total_quantity_tons, r.avg_order_size_tons, r.avg_delivery_days, r.delay_pct,
            r.avg_transport_cost_egp, r.total_revenue_egp,
        )
        for r in marts.regional_demand(orders, shipments).collect()
    }
    assert got == want
    top = marts.regional_demand(orders, shipments).filter("governorate = 'Cairo' AND company_id = 'A'").first()
    assert (top.top_product, top.top_customer_type) == ("p1", "c2")


@pytest.mark.parametrize(
    "on_time, reliability, swing, risk",
    [(80.0, 1.0, None, 28.0), (50.0, 0.0, 5.0, 30.0), (49.9, 2.0, 15.0, 66.0), (10.0, 1.0, 30.0, 73.0), (0.0, -1.0, 31.0, 85.0)],
)
def test_supplier_points(rows, on_time, reliability, swing, risk):
    df = rows([(on_time, reliability, swing)], "on_time_pct double, avg_reliability double, price_volatility double")
    row = df.withColumns(marts.supplier_points()).first()
    assert row.on_time_score + row.quality_score + row.price_score == risk


def test_profit_and_margin_fallbacks(rows):
    df = rows([(None, 10.0, None, None, -5.0)], "total_revenue_egp double, total_production_tons double, steel_price_egp double, total_logistics_cost_egp double, total_waste_tons double")
    assert df.select(marts.profit_estimate()).first()[0] == -6000.0
    schema = "total_revenue_egp double, total_production_tons double, avg_steel_price_egp double, total_logistics_cost_egp double"
    margins = rows([(1000.0, 1.0, 500.0, 100.0), (0.0, 1.0, 500.0, 100.0), (1000.0, 1.0, 500.0, None), (None, 1.0, 1.0, 1.0)], schema)
    assert [r[0] for r in margins.select(marts.gross_margin()).collect()] == [60.0, 0.0, None, 0.0]


def test_best_and_worst_shift_ties(rows):
    df = rows(
        [("A", "1", "L", s, e) for s, e in [("night", 50.0), ("morning", 90.0), ("afternoon", 90.0), ("morning", 90.0)]],
        "company_id string, factory_id string, production_line string, shift string, efficiency_pct double",
    )
    row = marts.best_and_worst_shift(marts.shift_means(df)).first()
    assert (row.best_shift, row.worst_shift) == ("afternoon", "night")


def test_price_features_cross_the_year(rows, collect):
    days = [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 2)]
    cols = marts.PRICE_FEATURE_INPUTS
    df = rows(
        [("T", "F", d, *[float(i + 1)] * len(cols)) for i, d in enumerate(days)],
        "company_id string, factory_id string, date date, " + ", ".join(f"{c} double" for c in cols),
    )
    got = collect(marts.price_features(df.unionByName(df.withColumn("company_id", F.lit("U")))), "date")
    assert [r["price_lag_1d"] for r in got] == [None, 1.0, 2.0]
    assert [r["moving_avg_7d"] for r in got] == [1.0, 1.5, 2.0]
    assert [r["usd_change_pct"] for r in got] == [None, 100.0, 50.0]


PROD = (
    "company_id string, factory_id string, batch_id string, planned_tons double, actual_tons double, waste_tons double,"
    "efficiency_pct double, net_output_tons double, shift string"
)


def test_repair(rows, collect):
    df = rows(
        [
            ("A", "1", "over", 100.0, 95.0, 5.0, 130.0, 90.0, "morning"),
            ("A", "1", "noplan", 0.0, 95.0, 100.0, 130.0, -5.0, "night"),
            ("A", "1", "idle", 50.0, 0.0, 0.0, 0.0, 0.0, "maintenance"),
            ("A", "1", "nowaste", 50.0, 40.0, None, 80.0, None, "x"),
            ("A", "1", "unknown", 50.0, None, 1.0, None, None, None),
        ],
        PROD,
    )
    got = {r["batch_id"]: r for r in collect(quality.repair_production(df))}
    assert [got[k]["efficiency_pct"] for k in ("over", "noplan", "idle", "nowaste")] == [95.0, 100.0, 0.0, 80.0]
    assert [got[k]["net_output_tons"] for k in got] == [90.0, 0.0, 0.0, 40.0, None]
    assert got["idle"]["is_underperforming"] == 1 and got["unknown"]["is_underperforming"] == 0
    exempt = {r["batch_id"]: r for r in collect(quality.repair_production(df, exempt_idle=True))}
    assert exempt["idle"]["is_underperforming"] == 0
    counts = quality.repair_counts(df).first().asDict()
    assert counts == {"capped_efficiency": 2, "idle_flag_cleared": 1, "net_output_rederived": 1}
    audit = quality.repair_audit(df, quality.repair_production(df)).first().asDict()
    assert audit["removed_rows"] == 0 and audit["zero_output"] == 2 and audit["null_efficiency"] == 1


def test_exact_percentiles_match_brute_force(spark):
    import math
    import random

    from millrace.plans.numbering import exact_percentiles

    rng = random.Random(7)
    # A third of all rows share one value.
    values = [5.0] * 400 + [round(rng.uniform(0, 100), 1) for _ in range(800)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(7)
    points = {"a": 0.0, "b": 0.05, "c": 0.33, "d": 0.5, "e": 0.95, "f": 1.0}
    want = {n: sorted(values)[max(math.ceil(p * len(values)), 1) - 1] for n, p in points.items()}
    assert exact_percentiles(df, "x", points).first().asDict() == want


def test_numbering_is_consecutive_and_ordered(spark):
    from millrace.plans.numbering import frequency_index, number_rows

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = number_rows(df, "n", ["x"]).orderBy("n").collect()
    assert [(r.x, r.n) for r in got] == [(i, i + 1) for i in range(1000)]
    labels = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "l string")
    index = {r.l: r.i for r in frequency_index(labels, "l", "i").collect()}
    assert index == {"b": 0.0, "a": 1.0, "c": 2.0, None: -1.0}


def test_profiles(rows, collect):
    df = rows([("a", 1, None), ("a", None, None), ("b", 3, 1)], "k string, x int, y int")
    assert {r["column_name"]: r["nulls"] for r in collect(quality.null_profile(df))} == {"k": 0, "x": 1, "y": 2}
    assert quality.duplicate_report(df, "k").first().asDict() == {"total_rows": 3, "distinct_keys": 2, "duplicates": 1}
    shares = {(r["column_name"], r["value"]): r["share_pct"] for r in collect(quality.category_profile(df, ["k"]))}
    assert shares[("k", "b")] == pytest.approx(100 / 3)
    report = collect(quality.range_report(rows([(10.0,), (None,)], "quantity_tons double"), "orders"))
    assert report == [{"feed": "orders", "column_name": "quantity_tons", "min_value": 10.0, "max_value": 10.0, "nulls": 1, "ok": True}]


def test_latest_change_with_one_day(rows):
    df = rows([(date(2024, 1, 1), 5.0)], "date date, p double")
    assert served.latest_change(df, "date", "p").first().asDict() == {
        "date": date(2024, 1, 1), "latest": 5.0, "previous": None, "change_pct": None,
    }
