"""Window helpers over ordered series, and tie-safe top-1 aggregates.

Every frame is ``ROWS``. A series is named by ``partition_by`` and ``order_by``. An empty
``partition_by`` gives one global window in one task; it is meant for tables that hold one row per
calendar day by construction (``one_row_per_date``), whose length the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from millrace.functions.guards import as_col


def series(partition_by: list[str] | None, order_by: str | list[str]) -> WindowSpec:
    order = [order_by] if isinstance(order_by, str) else order_by
    return (Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()).orderBy(*order)


def previous(value, over: WindowSpec, steps: int = 1) -> Column:
    return F.lag(as_col(value), steps).over(over)


def change_pct(value, over: WindowSpec, first: float | None = None, scale: int = 4) -> Column:
    """Percent change against the previous row; ``first`` where there is none (WIN-01, WIN-07)."""
    before = previous(value, over)
    change = F.round(F.try_divide(as_col(value) - before, before) * 100, scale)
    return change if first is None else F.when(before.isNotNull(), change).otherwise(F.lit(float(first)))


def _maybe_round(expr: Column, scale: int | None) -> Column:
    return expr if scale is None else F.round(expr, scale)


def moving_avg(value, over: WindowSpec, rows: int, scale: int | None = 2, lagged: bool = False) -> Column:
    """Mean of the last ``rows`` rows. ``lagged`` leaves the current row out (WIN-02, WIN-05, WIN-12)."""
    end = -1 if lagged else 0
    return _maybe_round(F.avg(as_col(value)).over(over.rowsBetween(end - rows + 1, end)), scale)


def rolling_std(value, over: WindowSpec, rows: int, scale: int | None = 2) -> Column:
    """Sample deviation of the last ``rows`` rows, null for a single row (WIN-03, WIN-06)."""
    return _maybe_round(F.stddev_samp(as_col(value)).over(over.rowsBetween(-rows + 1, 0)), scale)


def full_rolling_mean(value, over: WindowSpec, rows: int) -> Column:
    """Rolling mean that stays null until the frame is full (WIN-15)."""
    frame = over.rowsBetween(-rows + 1, 0)
    return F.when(F.count(as_col(value)).over(frame) >= rows, F.avg(as_col(value)).over(frame))


def top_label(label, weight) -> Column:
    """Aggregate: label of the largest weight, ties to the smallest label, null weights last.

    Needs no window and combines on the map side (WIN-08, WIN-09, TOP-03).
    """
    w = as_col(weight)
    return F.min_by(as_col(label), F.struct(w.isNull(), -w, as_col(label)))


def bottom_label(label, weight) -> Column:
    """Aggregate: label of the smallest weight, ties to the smallest label.

    Null weights come first, as they do in an ascending sort.
    """
    w = as_col(weight)
    return F.min_by(as_col(label), F.struct(w, as_col(label)))


def one_row_per_date(df: DataFrame, date_col: str, values: list[str], prefer: list[str]) -> DataFrame:
    """One row per date, the first by ``prefer``, then the one loaded last; a table copied under several tenants collapses.

    This is what makes a join on the date alone safe, and what bounds a global window.
    """
    picked = df.groupBy(date_col).agg(F.min_by(F.struct(*values), F.struct(*prefer, *newest_first(df), *values)).alias("_v"))
    return picked.select(date_col, *[F.col("_v")[c].alias(c) for c in values])


def newest_first(df: DataFrame, loaded: str = "loaded_at") -> list[Column]:
    """Sort keys that put the row loaded last first and rows without a load time last; none if the rows carry no time."""
    return [F.col(loaded).isNull(), -F.unix_micros(F.col(loaded).cast("timestamp"))] if loaded in df.columns else []


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the one loaded last, so a correction counts whichever way it goes, then the smallest by its
    other columns in their order. It makes a series daily before a window goes over it, so a feed with many rows
    a day is neither compared inside a day nor held by one task."""
    values = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*newest_first(df), *values)).alias("_v"))
    return picked.select(*[F.col(c) if c in keys else F.col("_v")[c].alias(c) for c in df.columns])


def first_rows(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First ``n`` rows per key under a total order (TOP-09).

    The rank filter becomes a per-task limit ahead of the shuffle, so a hot key sends at most
    ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
