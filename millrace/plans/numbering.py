"""Totals along a global order, without sorting everything in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import cut_lineage, staged

_ROW_BITS = 33  # rows per partition in monotonically_increasing_id


def running_total(
    df: DataFrame, name: str, weight: Column | None = None, order: list | None = None, total: str | None = None
) -> DataFrame:
    """Running sum of ``weight`` over the whole frame, in its order or in the given one.

    The sorted frame is checkpointed once, so its range partitions cannot change between the two
    passes: one sums each partition, the other adds the sum of the earlier partitions to the running
    sum inside. Only the per-partition sums meet in one task. Without a weight, rows are counted.
    ``total`` names a column for the grand total, which those sums give as well.
    """
    fixed = cut_lineage(df.orderBy(*order) if order else df)
    amount = F.lit(1) if weight is None else weight
    spot = fixed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    sizes = spot.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        *([F.sum("_sum").over(whole).alias(total)] if total else []),
    )
    if weight is None:
        inside = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    else:
        inside = F.sum(amount).over(Window.partitionBy("_part").orderBy("_at"))
    placed = spot.withColumn("_inside", inside).join(starts, "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_inside")).drop("_part", "_at", "_start", "_inside")


def number_rows(df: DataFrame, name: str, order: list | None = None) -> DataFrame:
    """Consecutive numbers from 1."""
    return running_total(df, name, None, order)


def exact_percentiles(df: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """One row with the exact discrete percentile of every named point.

    Rows are first combined to a count per distinct value on the map side; the counts are then summed
    along the values. Neither step holds the whole column in one task, as a sorted or sketched column
    of very many partitions would. The rank is a decimal product: as a double, 0.67 of 1500 is above 1005.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, "_upto", F.col("_n"), ["_v"], total="_all")
    rank = lambda p: F.ceil(F.col("_all") * F.lit(Decimal(str(p)))).cast("long")
    return placed.agg(
        *[
            F.min(F.when(F.col("_upto") >= F.greatest(rank(p), F.lit(1)), F.col("_v"))).alias(name)
            for name, p in points.items()
        ]
    )


def frequency_index(df: DataFrame, label: str, name: str) -> DataFrame:
    """Rank of the label by frequency, ties by label, from 0, added to every row; -1 if missing.

    The same numbers as an MLlib string index, but the labels stay in Spark: a supplier list may be
    long, and an index model would bring it to the driver.
    """
    counts = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = number_rows(counts.filter(F.col("_label").isNotNull()), "_no", [F.desc("_n"), F.asc("_label")])
    lookup = staged(ranked.select("_label", (F.col("_no") - 1).cast("double").alias(name)), "index")
    indexed = df.join(lookup, F.col(label) == F.col("_label"), "left").drop("_label")
    return indexed.withColumn(name, F.coalesce(name, F.lit(-1.0)))
