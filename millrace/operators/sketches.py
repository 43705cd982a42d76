"""Mergeable sketches: quantiles and distinct values of any union of days, without reading rows again.

A state row holds, per group, the number of rows, a KLL sketch of a measure and an HLL sketch of a key. States of new and
late rows are appended and merged when read, so a tenant, a month or the whole table is summed up from the same
rows. Both sketches are combined on the map side; their size does not grow with the rows behind them.

Null and NaN measures are left out of quantiles, null keys out of distinct counts; both count as rows. The exact forms
stay beside: ``quality.efficiency_distribution`` and ``quality.duplicate_report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.guards import as_col

#: Accuracy of the sketches: entries of a level (KLL), logarithm of the registers (HLL).
KLL_K = 1600
HLL_LG_K = 14
#: What the estimates keep to: share of rows between the wanted and the true rank, and relative error of a distinct count.
#: The single-sided rank error of KLL at this k is 0.18 % in 99 of 100 sketches, the standard error of HLL 0.8 %.
RANK_BOUND = 0.005
DISTINCT_BOUND = 0.04


def sketch_states(df: DataFrame, by: list[str], value, key) -> DataFrame:
    """One state row per group of ``by`` (none: one row)."""
    measure = as_col(value).cast("double")
    usable = F.when(~F.isnan(measure), measure)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(usable).alias("n_values"),
        F.kll_sketch_agg_double(usable, KLL_K).alias("quantiles"),
        F.hll_sketch_agg(as_col(key), HLL_LG_K).alias("keys"),
    )


def merged(states: DataFrame, by: list[str]) -> DataFrame:
    """States of coarser groups; merging merged states gives the same as merging all at once, within the bounds."""
    return states.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"),
        F.hll_union_agg("keys").alias("keys"),
    )


def quantile(p: float) -> Column:
    """Estimated quantile of a state; null where the group has no value."""
    return F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))))


def distribution(states: DataFrame, by: list[str], marks: dict[str, float]) -> DataFrame:
    """Estimated quantiles by name (AGG-10, AGG-19) of every group."""
    return merged(states, by).select(*by, "n_rows", "n_values", *[quantile(p).alias(name) for name, p in marks.items()])


def distinct_report(states: DataFrame, by: list[str]) -> DataFrame:
    """Rows, estimated distinct keys and estimated surplus rows (AGG-38, SET-04) of every group."""
    found = merged(states, by).select(*by, F.col("n_rows").alias("total_rows"), F.hll_sketch_estimate("keys").alias("distinct_keys"))
    return found.withColumn("duplicates", F.greatest(F.col("total_rows") - F.col("distinct_keys"), F.lit(0)))


def rank_errors(df: DataFrame, by: list[str], value, estimates: DataFrame, marks: dict[str, float]) -> DataFrame:
    """Per group and mark, the share of rows between the wanted rank and the nearest rank the estimate has.

    A value that repeats has all ranks from the first to the last of its rows. One pass over the rows, combined on the
    map side; the estimates, one row per group, are joined to the counted distinct values.
    """
    measure = as_col(value).cast("double")
    counts = df.filter(measure.isNotNull() & ~F.isnan(measure)).groupBy(*by, measure.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    sides = estimates.select(*[F.col(c).alias(f"_{c}") for c in by], "n_values", *marks)
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    met = counts.join(sides, same)
    sums = met.groupBy(*by).agg(*[
        a for m in marks for a in (
            F.sum(F.when(F.col("_v") < F.col(m), F.col("_n")).otherwise(0)).alias(f"_below_{m}"),
            F.sum(F.when(F.col("_v") <= F.col(m), F.col("_n")).otherwise(0)).alias(f"_upto_{m}"),
        )
    ], F.sum("_n").alias("_all"))
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("mark"),
            F.greatest(F.col(f"_below_{m}") / F.col("_all") - p, p - F.col(f"_upto_{m}") / F.col("_all"), F.lit(0.0)).alias("rank_error"),
        ) for m, p in marks.items()
    ])
    return sums.select(*by, F.inline(rows))
