"""WIN: ordered-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions import series
from millrace.ml import features as ml_features
from millrace.operators import cleaning, marts, served

PRICE = "steel_price_egypt_egp"
YEARLY = ["company_id", "factory_id", "year"]


def dated_market(f):
    return f.market.withColumn("year", F.year("date"))


def one_series(f):
    cols = [PRICE, "iron_ore_price_usd", "usd_egp_rate", "brent_oil_usd"]
    return series.one_row_per_date(f.market, "date", cols, ["company_id", "factory_id"])


@query("win_01_change_pct", "SELECT date, price_change_pct FROM mkt_c")
def _(f):
    over = series.series(YEARLY, "date")
    return dated_market(f).select("date", series.change_pct(PRICE, over, first=0.0).alias("price_change_pct"))


@query("win_02_moving_averages", "SELECT date, moving_avg_7d, moving_avg_30d FROM mkt_c")
def _(f):
    over = series.series(YEARLY, "date")
    return dated_market(f).select(
        "date",
        series.moving_avg(PRICE, over, 7).alias("moving_avg_7d"),
        series.moving_avg(PRICE, over, 30).alias("moving_avg_30d"),
    )


@query("win_03_rolling_stddev", "SELECT date, price_volatility_7d FROM mkt_c")
def _(f):
    over = series.series(YEARLY, "date")
    return dated_market(f).select("date", series.rolling_std(PRICE, over, 7).alias("price_volatility_7d"))


@query(
    "win_04_global_lags",
    "SELECT date, price_lag_1d, price_lag_7d, price_lag_14d, price_lag_30d FROM feat",
    r4="price_lag_1d price_lag_7d price_lag_14d price_lag_30d",
)
def _(f):
    return f.price_features.select("date", "price_lag_1d", "price_lag_7d", "price_lag_14d", "price_lag_30d")


@query(
    "win_05_global_moving_averages",
    "SELECT date, moving_avg_7d, moving_avg_14d, moving_avg_30d FROM feat",
    r4="moving_avg_7d moving_avg_14d moving_avg_30d",
)
def _(f):
    return f.price_features.select("date", "moving_avg_7d", "moving_avg_14d", "moving_avg_30d")


@query("win_06_global_rolling_stddev", "SELECT date, price_volatility_7d, price_volatility_30d FROM feat")
def _(f):
    return f.price_features.select("date", "price_volatility_7d", "price_volatility_30d")


@query("win_07_row_change_pct", "SELECT date, iron_ore_change_pct, usd_change_pct, oil_change_pct FROM feat")
def _(f):
    return f.price_features.select("date", "iron_ore_change_pct", "usd_change_pct", "oil_change_pct")


@query(
    "win_05b_lagged_moving_average",
    "SELECT date, avg(steel_price_egypt_egp) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) "
    "AS moving_avg_7d FROM mkt",
    r4="moving_avg_7d",
)
def _(f):
    return marts.price_features(f.market_clean, lagged=True).select("date", "moving_avg_7d")


@query(
    "win_08_monthly_leaders",
    """SELECT p.company_id, p.factory_id, p.year_val, p.month_val, top_product, top_governorate
       FROM lead_p AS p JOIN lead_g AS g ON p.company_id = g.company_id AND p.factory_id = g.factory_id
       AND p.year_val = g.year_val AND p.month_val = g.month_val""",
)
def _(f):
    return marts.monthly_leaders(f.orders)


@query("win_09_best_worst_shift", "SELECT * FROM shift_bw")
def _(f):
    return marts.best_and_worst_shift(marts.shift_means(f.production))


@query(
    "win_10_above_material_mean",
    """SELECT purchase_id, material_type, CAST(price_per_ton_usd > m AS INTEGER) AS is_expensive
       FROM purch JOIN (SELECT material_type, round(avg(price_per_ton_usd), 9) AS m FROM purch GROUP BY 1) AS a
       USING (material_type)""",
)
def _(f):
    return ml_features.above_group_mean(f.purchases, "price_per_ton_usd", "material_type", "is_expensive").select(
        "purchase_id", "material_type", "is_expensive"
    )


WEEKLY_SERIES = """SELECT week_start, product_type, region, weekly_demand_tons, {cols} FROM wk
    WINDOW w AS (PARTITION BY product_type, region ORDER BY week_start)"""


@query(
    "win_11_demand_lags",
    WEEKLY_SERIES.format(
        cols=", ".join(f"lag(weekly_demand_tons, {n}) OVER w AS demand_lag_{n}w" for n in (1, 2, 3, 4))
    ),
)
def _(f):
    df = ml_features.demand_history(ml_features.weekly_demand(f.orders_regional))
    lags = [f"demand_lag_{n}w" for n in (1, 2, 3, 4)]
    return df.select("week_start", "product_type", "region", "weekly_demand_tons", *lags)


@query(
    "win_12_demand_moving_averages",
    WEEKLY_SERIES.format(
        cols="""CAST(round(CAST(CAST(avg(weekly_demand_tons) OVER (PARTITION BY product_type, region
            ORDER BY week_start ROWS 3 PRECEDING) AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS demand_ma_4w,
            CAST(round(CAST(CAST(avg(weekly_demand_tons) OVER (PARTITION BY product_type, region
            ORDER BY week_start ROWS 7 PRECEDING) AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS demand_ma_8w"""
    ),
)
def _(f):
    df = ml_features.demand_history(ml_features.weekly_demand(f.orders_regional))
    return df.select("week_start", "product_type", "region", "weekly_demand_tons", "demand_ma_4w", "demand_ma_8w")


@query(
    "win_13_time_index",
    WEEKLY_SERIES.format(cols="CAST(row_number() OVER w AS DOUBLE) AS time_idx"),
)
def _(f):
    df = ml_features.demand_history(ml_features.weekly_demand(f.orders_regional))
    return df.select("week_start", "product_type", "region", "weekly_demand_tons", "time_idx")


@query(
    "win_14_line_mean_of_shifts",
    """SELECT *, avg(avg_eff_shift) OVER (PARTITION BY company_id, factory_id, production_line) AS line_avg
       FROM shift_m""",
    r4="avg_eff_shift line_avg",
)
def _(f):
    return served.shift_against_line(marts.shift_means(f.production))


CO2_MONTHS = "(SELECT month_start, sum(total_co2_kg) AS total_co2_kg FROM mon_t GROUP BY 1)"


@query(
    "win_15_co2_three_month_mean",
    f"""SELECT month_start, total_co2_kg, CASE WHEN count(total_co2_kg) OVER w >= 3
        THEN avg(total_co2_kg) OVER w END AS co2_ma3
        FROM {CO2_MONTHS} AS c WINDOW w AS (ORDER BY month_start ROWS 2 PRECEDING)""",
    r2="total_co2_kg co2_ma3",
)
def _(f):
    return served.co2_trend(served.co2_by_month(marts.monthly_totals(f.daily_kpis)))


@query(
    "win_16_mean_monthly_change",
    f"""SELECT avg((total_co2_kg - prev) / nullif(prev, 0)) * 100 AS trend_pct FROM (
        SELECT total_co2_kg, lag(total_co2_kg) OVER (ORDER BY month_start) AS prev FROM {CO2_MONTHS} AS c) AS x""",
    r4="trend_pct",
)
def _(f):
    return served.mean_change(served.co2_by_month(marts.monthly_totals(f.daily_kpis)), "month_start", "total_co2_kg")


@query(
    "win_17_latest_and_previous",
    """SELECT date, steel_price_egypt_egp AS latest, prev AS previous,
       (steel_price_egypt_egp - prev) / prev * 100 AS change_pct
       FROM (SELECT date, steel_price_egypt_egp, lag(steel_price_egypt_egp) OVER (ORDER BY date) AS prev FROM mkt) AS m
       ORDER BY date DESC LIMIT 1""",
    r4="latest previous change_pct",
)
def _(f):
    return served.latest_change(f.market, "date", PRICE)


def _corrected(f):
    """Two rows a day: a wrong one, above or below the right one in turn, and the right one loaded a day later."""
    at = lambda day: F.to_timestamp(F.lit(f"2025-01-0{day}"))
    wrong = f.market.withColumn(PRICE, F.col(PRICE) * F.when(F.dayofmonth("date") % 2 == 0, 0.5).otherwise(2.0))
    return wrong.withColumn("loaded_at", at(1)).unionByName(f.market.withColumn("loaded_at", at(2)))


@query(
    "win_01_corrected_rows",
    "SELECT date, price_change_pct, moving_avg_7d, moving_avg_30d, price_volatility_7d FROM mkt_c",
)
def _(f):
    names = ["price_change_pct", "moving_avg_7d", "moving_avg_30d", "price_volatility_7d"]
    return cleaning.clean_market(_corrected(f)).select("date", *names)
