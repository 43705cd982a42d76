"""Cleaned layer on edge rows: missing days, zero divisors, nulls, year ends, two tenants."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning
from millrace.plans.joins import attach_market

MARKET = (
    "company_id string, factory_id string, date date, steel_price_egypt_egp double, iron_ore_price_usd double,"
    "scrap_price_usd double, usd_egp_rate double, natural_gas_price_usd double, electricity_price_egp_kwh double"
)


def market_row(d, price, company="M", rate=30.0):
    return (company, "ALL", d, price, 100.0, 50.0, rate, 2.0, 1.5)


@pytest.fixture
def market(rows):
    return rows(
        [
            market_row(date(2023, 12, 30), 100.0),
            market_row(date(2023, 12, 31), 103.0),
            market_row(date(2024, 1, 1), 200.0),
            market_row(None, 1.0),
        ],
        MARKET,
    )


def test_market_window_resets_at_year_end(market, collect):
    got = collect(cleaning.clean_market(market), "date")
    assert [r["price_change_pct"] for r in got] == [0.0, 3.0, 0.0]
    assert [r["is_price_spike"] for r in got] == [0, 1, 0]
    assert [r["moving_avg_7d"] for r in got] == [100.0, 101.5, 200.0]
    assert [r["price_volatility_7d"] for r in got] == [None, 2.12, None]
    assert {r["iron_ore_price_egp"] for r in got} == {3000.0}


def test_change_is_from_day_to_day(rows):
    days = [(1, 100.0), (1, 110.0), (1, 100.0), (2, 103.0), (2, 120.0)]
    got = cleaning.clean_market(rows([market_row(date(2024, 1, d), p, "A") for d, p in days], MARKET)).orderBy("date").collect()
    assert [(r.date.day, r.price_change_pct) for r in got] == [(1, 0.0), (2, 3.0)]


def test_two_market_rows_on_a_date_do_not_multiply(rows):
    market = rows([market_row(date(2024, 1, 1), 1.0, "B"), market_row(date(2024, 1, 1), 2.0, "A")], MARKET)
    facts = rows([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2)], "d date, k int")
    got = attach_market(facts, "d", market, {"steel_price_egypt_egp": "p"}).orderBy("k").collect()
    assert [(r.k, r.p) for r in got] == [(1, 2.0), (2, None)]


def test_production_edges(rows, market, collect):
    df = rows(
        [
            ("ok", date(2024, 1, 1), "morning", 10.0, 1.0, 70.0, 100.0, 10.0),
            ("idle", date(2024, 1, 1), "maintenance", 0.0, 0.0, 0.0, 100.0, 10.0),
            ("gap", date(2024, 6, 1), None, None, 1.0, None, 100.0, 10.0),
        ],
        "batch_id string, date date, shift string, actual_tons double, waste_tons double, efficiency_pct double,"
        "energy_kwh double, natural_gas_m3 double",
    )
    got = {r["batch_id"]: r for r in collect(cleaning.clean_production(df, market))}
    assert got["ok"]["net_output_tons"] == 9.0 and got["ok"]["energy_per_ton"] == 10.0
    assert got["ok"]["is_underperforming"] == 0  # exactly 70
    assert got["ok"]["estimated_energy_cost_egp"] == 100 * 1.5 + 10 * 2.0 * 30.0
    assert got["idle"]["energy_per_ton"] == 0.0 and got["idle"]["is_underperforming"] == 1
    assert got["gap"]["estimated_energy_cost_egp"] == 100 * 3.5 + 10 * 3.0 * 50.0
    assert got["gap"]["net_output_tons"] is None and got["gap"]["is_underperforming"] == 0
    assert [got[k]["shift_rank"] for k in ("ok", "idle", "gap")] == [1, 4, 4]


@pytest.mark.parametrize(
    "status, delay, score",
    [
        ("cancelled", -5, 0.0), ("delivered", -1, 100.0), ("delivered", 0, 100.0), ("delivered", 2, 80.0),
        ("delivered", 5, 60.0), ("delivered", 10, 40.0), ("delivered", 11, 20.0), ("delivered", None, 20.0),
        (None, 0, 100.0),
    ],
)
def test_delivery_score(rows, status, delay, score):
    df = rows([(status, delay)], "status string, delay_days int")
    assert df.select(cleaning.delivery_score()).first()[0] == score


def test_regions(rows):
    df = rows([("Cairo",), ("Aswan",), ("New_Capital",), (None,)], "g string")
    assert [r[0] for r in df.select(cleaning.region_of("g")).collect()] == ["Greater_Cairo", "Upper_Egypt", "Other", "Other"]


def test_shipment_edges(rows, collect):
    df = rows(
        [
            ("a", date(2024, 1, 1), date(2024, 1, 3), 100, 10.0, 50.0, 20.0, 5.0, 3.5),
            ("b", date(2024, 1, 1), date(2024, 1, 1), 100, 0.0, 50.0, 20.0, 5.0, 3.6),
            ("c", date(2024, 1, 1), None, 100, None, 50.0, 20.0, 5.0, None),
        ],
        "shipment_id string, departure_date date, arrival_date date, distance_km int, weight_tons double,"
        "transport_cost_egp double, fuel_liters double, co2_emissions_kg double, cost_per_ton_km_egp double",
    )
    got = {r["shipment_id"]: r for r in collect(cleaning.clean_shipments(df))}
    assert [got[k]["delivery_speed_km_per_day"] for k in "abc"] == [50.0, 100.0, 100.0]
    assert [got[k]["transit_days"] for k in "abc"] == [2, 0, None]
    assert [got[k]["cost_per_ton"] for k in "abc"] == [5.0, 0.0, 0.0]
    assert [got[k]["is_efficient"] for k in "abc"] == [1, 0, 0]


def test_market_join_keeps_no_cache(spark, rows):
    market = rows([market_row(date(2024, 1, 1), 1.0, "B")], MARKET)
    attach_market(rows([(date(2024, 1, 1), 1)], "d date, k int"), "d", market, {"steel_price_egypt_egp": "p"})
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_statistics_of_an_empty_table(rows):
    df = rows([], "x int")
    got = cleaning.layer_statistics(df, "t", F.col("x") == 1, "x").first().asDict()
    assert got == {"table_name": "t", "total_rows": 0, "flagged_rows": 0, "flagged_pct": 0.0, "mean_value": 0.0}
