"""External price histories and the harvested market feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.guards import to_number

# Output field, flat alias and nested alias of the harvested feed.
FEED_ALIASES = {
    "steel_price_egypt_egp": ("rebar_egp", "rebar.egp"),
    "iron_ore_price_usd": ("iron_ore_usd", "iron_ore.usd"),
    "scrap_price_usd": ("scrap_usd", "scrap.usd"),
    "coking_coal_price_usd": ("coking_coal_usd", "coking_coal.usd"),
    "billet_price_usd": ("billet_usd", "billet.usd"),
    "usd_egp_rate": ("usd_egp", "fx.usd_egp"),
}


class EmptyHarvest(ValueError):
    """No usable record in a harvest."""


def price_history(df: DataFrame, time_col: str = "Date", invert: str | None = None) -> DataFrame:
    """Dates as ``yyyy-MM-dd``; ``invert`` adds the inverse rate of that column (SRC-07)."""
    out = df.withColumn(time_col, F.date_format(time_col, "yyyy-MM-dd"))
    if invert:
        out = out.withColumn("usd_egp_rate", F.try_divide(F.lit(1.0), F.col(invert)))
    return out


def price_range(df: DataFrame, value: str) -> DataFrame:
    """Rows and range of a price column (SRC-07)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )


def explode_rates(df: DataFrame, body: str, currency: str = "EGP") -> DataFrame:
    """JSON body ``{"rates": {date: {currency: rate}}}`` to one row per date (SRC-07)."""
    parsed = F.from_json(F.col(body), "rates map<string, map<string, double>>")
    rates = df.select(F.explode(parsed["rates"]).alias("date", "rates"))
    return rates.select("date", F.coalesce(F.try_element_at("rates", F.lit(currency)), F.lit(0.0)).alias("usd_egp_rate"))


def _field(df: DataFrame, flat: str, nested: str) -> Column:
    """Flat alias first, then the nested one, where the frame has them; non-numbers become null."""
    found = []
    if flat in df.columns:
        found.append(to_number(F.col(flat)))
    parent, child = nested.split(".")
    if parent in df.columns:
        found.append(to_number(F.col(parent)[child]))
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def scrub_market(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Harvested records as market rows (SRC-08): aliases resolved, default date, and records
    without both core prices dropped."""
    today = F.current_date() if today is None else today
    date = F.coalesce(F.col("date").try_cast("date"), today) if "date" in df.columns else today
    rows = df.select(date.alias("date"), *[_field(df, *names).alias(out) for out, names in FEED_ALIASES.items()])
    return rows.filter(F.col("steel_price_egypt_egp").isNotNull() | F.col("iron_ore_price_usd").isNotNull())


def require_rows(df: DataFrame) -> DataFrame:
    """Fail a harvest that came out empty."""
    if df.isEmpty():
        raise EmptyHarvest("market harvest produced no valid records")
    return df
