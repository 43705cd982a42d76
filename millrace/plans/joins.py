"""Join helpers. Sides carry no hints: Spark broadcasts what it measures as small and splits skewed keys of
the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.series import one_row_per_date
from millrace.schemas import TENANT_KEYS


def attach_market(facts: DataFrame, date_col: str, market: DataFrame, values: dict[str, str]) -> DataFrame:
    """Left join of same-day market values under new names (JN-01, JN-05).

    The market side is reduced to one row per date first, so a copy per tenant cannot multiply facts.
    """
    prefer = [c for c in TENANT_KEYS if c in market.columns] or ["date"]
    columns = sorted(set(values))
    daily = one_row_per_date(market, "date", columns, prefer)
    side = daily.select(F.col("date").alias("_day"), *[F.col(src).alias(dst) for src, dst in values.items()])
    return facts.join(side, facts[date_col] == F.col("_day"), "left").drop("_day")
