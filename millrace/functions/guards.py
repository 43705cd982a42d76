"""Null-safe and ANSI-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(num, den, scale: int | None = 2, default: float | None = 0.0) -> Column:
    """``num / den`` where the divisor is positive, otherwise ``default`` (SCL-04)."""
    ratio = F.try_divide(as_col(num), as_col(den))
    if scale is not None:
        ratio = F.round(ratio, scale)
    return F.when(as_col(den) > 0, ratio).otherwise(F.lit(default).cast("double"))


def safe_pct(num, den) -> Column:
    """Share in percent; 0 for an empty or missing denominator (SCL-27)."""
    return F.coalesce(F.try_divide(as_col(num).cast("double"), as_col(den).cast("double")) * 100, F.lit(0.0))


def share_pct(part, whole, scale: int = 2) -> Column:
    """Share in percent, null for an empty denominator."""
    return F.round(F.try_divide(as_col(part), as_col(whole)) * 100, scale)


def steady(expr: Column, scale: int) -> Column:
    """Round a mean or sum so that summation order cannot decide a half: first to 9 places."""
    return F.round(F.round(expr, 9), scale)


def or_else(value, fallback: float) -> Column:
    return F.coalesce(as_col(value), F.lit(float(fallback)))


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(cond, 1).otherwise(0).cast("int")


def convert(amount, rate, fallback: float | None = None, scale: int = 2) -> Column:
    """Currency conversion with an optional fall-back rate (SCL-02)."""
    factor = as_col(rate) if fallback is None else or_else(rate, fallback)
    return F.round(as_col(amount) * factor, scale)


def band(value, cuts: list[tuple[float, str]], otherwise: str, inclusive: bool = False, above: bool = True) -> Column:
    """First matching label of ordered cut points (SCL-26).

    ``above`` compares ``value > cut`` (``>=`` when inclusive); otherwise ``<`` / ``<=``.
    """
    col = as_col(value)
    compare = {
        (True, False): lambda c: col > c,
        (True, True): lambda c: col >= c,
        (False, False): lambda c: col < c,
        (False, True): lambda c: col <= c,
    }[(above, inclusive)]
    expr = None
    for cut, label in cuts:
        expr = F.when(compare(cut), label) if expr is None else expr.when(compare(cut), label)
    return expr.otherwise(otherwise)


def to_number(value) -> Column:
    """Text to double, bad values to null (PRJ-18)."""
    return as_col(value).try_cast("double")


def to_whole(value) -> Column:
    return as_col(value).try_cast("int")


def to_time(value) -> Column:
    return as_col(value).try_cast("timestamp")
