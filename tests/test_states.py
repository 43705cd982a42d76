import random

from millrace.operators import marts, states
from millrace.sinks import snapshots

SCHEMA = (
    "company_id string, factory_id string, supplier_name string, origin_country string, material_type string, purchase_id string,"
    " purchase_date date, quantity_tons double, price_per_ton_usd double, lead_time_days int, on_time boolean, supplier_reliability double"
)


def test_states_equal_a_full_rebuild_after_late_rows(spark, rows, tmp_path):
    import datetime

    rng, path = random.Random(1), str(tmp_path / "states")
    data = [
        (rng.choice("AB"), None, rng.choice(["s1", "s2", None]), "x", "iron", str(i), datetime.date(2024, 1, rng.randint(1, 5)),
         rng.choice([None, 2.0, 3.5]), rng.choice([None, 1e9 + rng.random()]), rng.choice([None, 4]), rng.choice([True, False, None]), 0.5)
        for i in range(400)
    ] + [("A", "f", "alone", "x", "iron", "900", datetime.date(2024, 1, 1), 1.0, 7.0, None, None, None)]
    df = rows(data, SCHEMA)
    for part in ("day(purchase_date) < 3 and int(purchase_id) % 7 > 0", "day(purchase_date) >= 3 and int(purchase_id) % 7 > 0", "int(purchase_id) % 7 = 0"):
        states.add_purchases(df.filter(part), path)
    fresh = lambda: {tuple(r[k] for k in marts.SCORECARD_KEYS): r for r in states.supplier_totals(snapshots.read_snapshot(spark, path)).collect()}
    before = fresh()
    states.compact_purchases(spark, path)
    table = snapshots.read_snapshot(spark, path)
    assert table.count() == df.select(*marts.SCORECARD_KEYS, "purchase_date").distinct().count()
    want = {tuple(r[k] for k in marts.SCORECARD_KEYS): r for r in marts.supplier_totals(df).collect()}
    for got in (before, fresh()):
        assert got.keys() == want.keys()
        for key, row in want.items():
            for c, a in row.asDict().items():
                b = got[key][c]
                assert a == b or abs(a - b) <= (1e-4 if c == "price_volatility" else 1e-9 * abs(a)), (key, c, a, b)


FACTS = {
    "production": "company_id string, factory_id string, date date, actual_tons double, efficiency_pct double, waste_tons double, energy_kwh double",
    "orders": "company_id string, factory_id string, order_id string, order_date date, quantity_tons double, total_value_egp double,"
    " status string, product_type string, delivery_governorate string",
    "shipments": "company_id string, factory_id string, shipment_id string, departure_date date, transport_cost_egp double,"
    " co2_emissions_kg double, fuel_liters double, cost_per_ton_km_egp double",
}


def test_kpi_states_equal_a_full_rebuild(spark, rows, tmp_path):
    import datetime

    from pyspark.sql import functions as F

    rng = random.Random(3)
    day = lambda: datetime.date(2024, rng.randint(1, 2), rng.randint(1, 3))
    some = lambda: rng.choice([None, 1.5, 60.0, 80.25])
    key = lambda: (rng.choice("AB"), rng.choice(["f", "g"]))
    data = {
        "production": [(*key(), day(), some(), some(), some(), some()) for _ in range(150)],
        "orders": [
            (*key(), rng.choice([None, str(i)]), day(), some(), some(), rng.choice(["delivered", "Cancelled", None]), rng.choice("pq"), rng.choice("xyz"))
            for i in range(150)
        ],
        "shipments": [(*key(), str(i), day(), some(), some(), some(), some()) for i in range(150)],
    }
    frames = {n: rows(d, FACTS[n]) for n, d in data.items()}
    market = rows([(datetime.date(2024, 1, 1), 5.0, 2.0)], "date date, steel_price_egypt_egp double, usd_egp_rate double")
    kept = states.KpiStates(str(tmp_path / "kpi"))
    cut = lambda part: {n: rows([r for i, r in enumerate(d) if i % 3 == part], FACTS[n]) for n, d in data.items()}
    kept.add(**cut(0), batch=1)
    # A batch that died behind its first table is given again, then once more as a replay.
    kept.add(production=cut(1)["production"], batch=2)
    kept.add(**cut(1), batch=2)
    kept.add(**cut(1), batch=2)
    kept.add(**cut(2), batch=3)

    def same(got, want):
        ordered = lambda df: sorted(map(tuple, df.select(*want.columns).collect()), key=str)
        number = lambda v: round(v, 6) if isinstance(v, float) else v
        assert [tuple(map(number, r)) for r in ordered(got)] == [tuple(map(number, r)) for r in ordered(want)]

    daily = marts.daily_kpis(*frames.values(), market)
    for _ in range(2):
        for got, want in zip(kept.days(spark), (marts.daily_production, marts.daily_orders, marts.daily_shipments)):
            same(got, want(frames[want.__name__.removeprefix("daily_")]))
        same(kept.daily(market), daily)
        same(kept.monthly(market), marts.monthly_summary(daily, frames["orders"]))
        kept.compact(spark)
    # Compaction carries the batch number on.
    kept.add(**cut(2), batch=3)
    same(kept.daily(market), daily)
    table = snapshots.read_snapshot(spark, f"{kept.path}/production")
    assert table.count() == table.select("company_id", "factory_id", "date").distinct().count()
    assert table.agg(F.sum("actual_n")).first()[0] == sum(r[3] is not None for r in data["production"])


def test_states_of_a_key_meet_without_a_join(spark, rows, tmp_path):
    import datetime

    path, day = str(tmp_path / "states"), datetime.date(2024, 1, 1)
    for price in (1e9 + 0.25, 1e9 + 0.75, None):
        states.add_purchases(rows([("A", "f", "s", "x", "iron", "1", day, 1.0, price, 3, True, 0.5)], SCHEMA), path)
    read = states.supplier_states().read(spark, path)
    assert "Join" not in read._jdf.queryExecution().sparkPlan().toString()
    (row,) = read.collect()
    assert (row.total_purchases, row.price_n, row.price_mean, row.price_dev) == (3, 2, 1e9 + 0.5, 0.125)


def test_batches_of_the_query_read_stored_purchases(spark, sf_dir, monkeypatch):
    import __spark_entry__ as contract

    plans, add = [], states.add_purchases
    monkeypatch.setattr(states, "add_purchases", lambda rows, path: plans.append(rows._jdf.queryExecution().sparkPlan().toString()) or add(rows, path))
    contract.queries()["agg_05_incremental_totals"](spark, sf_dir)
    assert len(plans) == 3 and all("lineitem.parquet" not in plan for plan in plans)
