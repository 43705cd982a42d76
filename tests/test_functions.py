"""Guards, calendar, text and window helpers on hand-written rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, guards, series, text


def one(df):
    return df.first().asDict()


def test_guarded_ratio(rows):
    df = rows([(10.0, 4.0), (10.0, 0.0), (10.0, -2.0), (10.0, None), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(guards.safe_ratio("n", "d")).collect()]
    assert got == [2.5, 0.0, 0.0, 0.0, None]


def test_percentages(rows):
    df = rows([(1, 4), (1, 0), (1, None)], "n int, d int")
    assert [r[0] for r in df.select(guards.safe_pct("n", "d")).collect()] == [25.0, 0.0, 0.0]
    assert [r[0] for r in df.select(guards.share_pct("n", "d")).collect()] == [25.0, None, None]


def test_flags_treat_null_as_false(rows):
    df = rows([(69.9,), (70.0,), (None,)], "x double")
    assert [r[0] for r in df.select(guards.flag(F.col("x") < 70)).collect()] == [1, 0, 0]


def test_bad_text_becomes_null(rows):
    df = rows([("1.5", "7"), ("abc", "x"), (None, None)], "a string, b string")
    got = df.select(guards.to_number("a"), guards.to_whole("b")).collect()
    assert [tuple(r) for r in got] == [(1.5, 7), (None, None), (None, None)]


def test_bands(rows):
    df = rows([(50.0,), (49.0,), (25.0,), (24.9,), (None,)], "x double")
    got = [r[0] for r in df.select(guards.band("x", [(50, "r"), (25, "a")], "g", inclusive=True)).collect()]
    assert got == ["r", "a", "a", "g", "g"]


def test_currency_falls_back(rows):
    df = rows([(2.0, 30.0), (2.0, None)], "usd double, rate double")
    assert [r[0] for r in df.select(guards.convert("usd", "rate", 50.0)).collect()] == [60.0, 100.0]


def test_calendar(rows):
    df = rows([(date(2024, 1, 7),)], "d date")  # a Sunday
    parts = dates.calendar_parts("d", {"day_of_week": "dow", "iso_week": "w", "quarter": "q"})
    assert one(df.select(*[c.alias(n) for n, c in parts.items()])) == {"dow": 1, "w": 1, "q": 1}
    assert one(df.select(dates.week_start("d").alias("w"), dates.month_start("d").alias("m"))) == {
        "w": date(2024, 1, 1), "m": date(2024, 1, 1),
    }


def test_days_between_with_missing_dates(rows):
    df = rows([(date(2024, 1, 5), date(2024, 1, 1)), (None, date(2024, 1, 1))], "a date, b date")
    assert [r[0] for r in df.select(dates.days_between("a", "b")).collect()] == [4, None]
    assert [r[0] for r in df.select(dates.days_between("a", "b", default=0)).collect()] == [4, 0]


def test_periods(rows):
    df = rows([(date(2023, 12, 31),), (date(2024, 1, 1),), (date(2024, 3, 1),)], "d date")
    assert dates.in_period(df, "d", "all").count() == 3
    assert dates.in_period(df, "d", "2024").count() == 2
    assert dates.in_period(df, "d", "last_30_days").count() == 1
    with pytest.raises(KeyError):
        dates.in_period(df, "d", "yesterday")


def test_slug(rows):
    df = rows([("  Steel & Co. / North  ",), ("!!!",), ("a" * 30,)], "t string")
    assert [r[0] for r in df.select(text.slug("t")).collect()] == ["STEEL_CO_NORTH", "UNIT", "A" * 30]
    assert [r[0] for r in df.select(text.company_code("t")).collect()] == ["STEELCONORTH", "FACTORY", "A" * 30]


def test_product_size(rows):
    df = rows([("rebar_12mm",), ("coil",), (None,)], "p string")
    assert [r[0] for r in df.select(text.product_size("p")).collect()] == ["12mm", "N/A", "N/A"]


def test_change_resets_per_partition_and_survives_zero(rows):
    df = rows(
        [("a", 1, 10.0), ("a", 2, 11.0), ("a", 3, 0.0), ("a", 4, 5.0), ("b", 1, 7.0)], "g string, t int, x double"
    )
    over = series.series(["g"], "t")
    got = df.withColumn("c", series.change_pct("x", over, first=0.0)).orderBy("g", "t").collect()
    assert [r.c for r in got] == [0.0, 10.0, -100.0, None, 0.0]


def test_rolling(rows):
    df = rows([(i, float(i)) for i in range(1, 6)], "t int, x double")
    over = series.series(None, "t")
    out = df.select(
        "t",
        series.moving_avg("x", over, 3).alias("m"),
        series.moving_avg("x", over, 3, lagged=True).alias("l"),
        series.rolling_std("x", over, 3).alias("s"),
        series.full_rolling_mean("x", over, 3).alias("f"),
    ).orderBy("t").collect()
    assert [r.m for r in out] == [1.0, 1.5, 2.0, 3.0, 4.0]
    assert [r.l for r in out] == [None, 1.0, 1.5, 2.0, 3.0]
    assert [r.s for r in out] == [None, 0.71, 1.0, 1.0, 1.0]
    assert [r.f for r in out] == [None, None, 2.0, 3.0, 4.0]


def test_top_label_ties_and_nulls(rows):
    df = rows([("b", 5), ("a", 5), ("c", None), ("d", 1)], "l string, w int")
    assert one(df.agg(series.top_label("l", "w").alias("t"), series.bottom_label("l", "w").alias("b"))) == {
        "t": "a", "b": "c",
    }


def test_one_row_per_date_collapses_tenants(rows, collect):
    df = rows(
        [(date(2024, 1, 1), "B", 2.0), (date(2024, 1, 1), "A", 1.0), (date(2024, 1, 2), "B", 3.0)],
        "date date, company_id string, x double",
    )
    got = collect(series.one_row_per_date(df, "date", ["x"], ["company_id"]), "date")
    assert [r["x"] for r in got] == [1.0, 3.0]


def test_first_rows_limits_before_the_shuffle(rows):
    df = rows([("hot", i) for i in range(100)] + [("cold", 1)], "g string, i int")
    out = series.first_rows(df, ["g"], ["i"], 3)
    assert out.count() == 4
    plan = out._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_newest_row_of_a_key_wins_whichever_way_it_goes(rows, collect):
    df = rows(
        [("a", 1.0, "2024-01-01"), ("a", 9.0, "2024-01-02"), ("b", 9.0, "2024-01-01"), ("b", 1.0, "2024-01-02"),
         ("c", 5.0, None), ("c", 7.0, "2024-01-01"), ("d", 3.0, "2024-01-01"), ("d", 2.0, "2024-01-01")],
        "k string, x double, loaded_at string",
    ).selectExpr("k", "x", "to_timestamp(loaded_at) AS loaded_at")
    want = {"a": 9.0, "b": 1.0, "c": 7.0, "d": 2.0}
    assert {r["k"]: r["x"] for r in collect(series.one_row_per_key(df, ["k"]))} == want
    assert {r["k"]: r["x"] for r in collect(series.one_row_per_date(df, "k", ["x"], ["k"]))} == want
    assert {r["k"]: r["x"] for r in collect(series.one_row_per_key(df.drop("loaded_at"), ["k"]))} == {"a": 1.0, "b": 1.0, "c": 5.0, "d": 2.0}
