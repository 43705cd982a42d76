"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.guards import as_col


def calendar_parts(date_col: str, names: dict[str, str]) -> dict[str, Column]:
    """Selected parts under chosen names (DAT-01); ``names`` maps part to output column."""
    makers = {
        "year": F.year,
        "month": F.month,
        "quarter": F.quarter,
        "day_of_week": F.dayofweek,  # 1 is Sunday
        "iso_week": F.weekofyear,
    }
    return {out: makers[part](date_col) for part, out in names.items()}


def month_start(date_col) -> Column:
    """First day of the month (DAT-02)."""
    return F.trunc(as_col(date_col), "MM")


def week_start(date_col) -> Column:
    """Monday of the week, as a date (DAT-03)."""
    return F.trunc(as_col(date_col), "week")


def days_between(later, earlier, default: int | None = None) -> Column:
    """Whole days; ``default`` where either date is missing (DAT-04)."""
    gap = F.datediff(as_col(later), as_col(earlier))
    return gap if default is None else F.coalesce(gap, F.lit(default))


def in_period(df: DataFrame, date_col: str, period: str) -> DataFrame:
    """Dashboard presets (PRJ-11): ``all``, a year such as ``2024``, or the last 30 / 90 / 180 days.

    Relative presets anchor on the newest date of the data, found by a scalar subquery.
    """
    spans = {"last_30_days": 30, "last_90_days": 90, "last_6_months": 180}
    if period == "all":
        return df
    if period.isdigit():
        year = int(period)
        return df.filter((F.col(date_col) >= f"{year}-01-01") & (F.col(date_col) < f"{year + 1}-01-01"))
    newest = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) >= F.date_sub(newest, spans[period]))


def stamp(df: DataFrame, name: str = "loaded_at", at: Column | None = None) -> DataFrame:
    """Replace the processing-time column (PRJ-09, DAT-05); pass ``at`` for a fixed run time."""
    return df.drop(name).withColumn(name, F.current_timestamp() if at is None else at)
