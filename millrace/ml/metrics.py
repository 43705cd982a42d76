"""Model metrics and supplier roll-ups as DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import guards
from millrace.plans.numbering import exact_percentiles
from millrace.plans.scalars import with_thresholds
from millrace.session import staged


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE, R2 and two percentages (AGG-21).

    ``mape`` is the mean absolute error over the mean actual value, as published; ``mape_true`` is
    the mean of the row percentages. R2 needs the mean first, which the sums of squares give in the
    same pass: around the mean, the total is ``var_pop * n``.
    """
    err = F.col(predicted) - F.col(actual)
    sums = df.select(F.col(actual).alias("a"), err.alias("e")).agg(
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.avg(F.abs("e")).alias("mae"),
        F.avg("a").alias("mean_actual"),
        F.sum(F.col("e") * F.col("e")).alias("ss_res"),
        (F.var_pop("a") * F.count("a")).alias("ss_tot"),
        (F.avg(F.abs(F.try_divide("e", "a"))) * 100).alias("mape_true"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return sums.select(
        "rmse",
        "mae",
        (F.try_divide("mae", "mean_actual") * 100).alias("mape"),
        "mape_true",
        (F.lit(1.0) - F.try_divide("ss_res", "ss_tot")).alias("r2"),
        "n_rows",
    )


def group_errors(df: DataFrame, by: str, actual: str, predicted: str) -> DataFrame:
    """Totals and error percent per group, largest first (AGG-23)."""
    totals = df.groupBy(by).agg(
        guards.steady(F.sum(actual), 2).alias("actual_total"), guards.steady(F.sum(predicted), 2).alias("predicted_total")
    )
    gap = F.abs(F.col("predicted_total") - F.col("actual_total"))
    return totals.withColumn("error_pct", F.round(F.try_divide(gap, F.col("actual_total")) * 100, 2)).orderBy(
        F.desc("actual_total"), by
    )


def label_counts(df: DataFrame, *labels: str) -> DataFrame:
    """Rows per label or label pair (AGG-20)."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(*labels)


def supplier_rollup(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Risk per supplier with its factors (AGG-18, SCL-18). Price tiers.

    Rows are first added up by supplier, country and material, which is hashed; the least country and material of a
    supplier come from those sums. A least text beside the rows would have all rows sorted by supplier.
    """
    means = {  # value, factor, digits
        "avg_risk_score": (prediction, 1, 2), "actual_avg_risk": ("risk_points", 1, 2), "late_delivery_pct": ("is_late", 100, 2),
        "avg_quality": ("quality_num", 1, 2), "avg_lead_time": ("lead_time_days", 1, 1),
        "avg_price_usd": ("price_per_ton_usd", 1, 2), "avg_reliability": ("supplier_reliability", 1, 4),
    }
    parts = scored.groupBy("supplier_name", "origin_country", "material_type").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(c).cast("double")).alias(f"{name}_sum") for name, (c, _, _) in means.items()],
        *[F.count(c).alias(f"{name}_n") for name, (c, _, _) in means.items()],
    )
    mean = lambda name: F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))
    rolled = {name: guards.steady(mean(name) * factor, digits).alias(name) for name, (_, factor, digits) in means.items()}
    grouped = parts.groupBy("supplier_name").agg(
        F.min("origin_country").alias("origin_country"),
        F.min("material_type").alias("material_type"),
        rolled.pop("avg_risk_score"),
        rolled.pop("actual_avg_risk"),
        F.sum("_n").alias("total_deliveries"),
        *rolled.values(),
    )
    price = F.col("avg_price_usd")
    return grouped.withColumns(
        {
            "on_time_factor": F.round(F.lit(100) - F.col("late_delivery_pct"), 2),
            "quality_factor": F.round(F.col("avg_quality") / 4 * 100, 2),
            "price_factor": F.when(price > 200, 40.0).when(price > 100, 60.0).when(price > 50, 80.0).otherwise(90.0),
        }
    )


def risk_levels(suppliers: DataFrame, score: str = "avg_risk_score") -> DataFrame:
    """LOW / MEDIUM / HIGH by the 33rd and 67th centile of the scores (AGG-19).

    The suppliers are staged: the centiles and the rows both read them, and their deliveries are read once.
    """
    suppliers = staged(suppliers, "suppliers")
    graded = with_thresholds(suppliers, exact_percentiles(suppliers, score, {"_low": 0.33, "_high": 0.67}))
    level = F.when(F.col(score) >= F.col("_high"), "HIGH").when(F.col(score) >= F.col("_low"), "MEDIUM").otherwise("LOW")
    return graded.withColumn("risk_level", level).drop("_low", "_high")


def extremes(suppliers: DataFrame, n: int = 3, riskiest: bool = False, score: str = "avg_risk_score") -> DataFrame:
    """Safest or riskiest suppliers (TOP-04)."""
    order = F.desc(score) if riskiest else F.asc(score)
    return suppliers.orderBy(order, "supplier_name").limit(n)


def classification_metrics(df: DataFrame, label: str, prediction: str, focus: int = 2) -> DataFrame:
    """Accuracy, weighted F1, precision and recall, and those of one label (ML-07).

    One pass reduces the rows to a confusion matrix; the metrics are arithmetic on its few cells.
    """
    cells = df.groupBy(F.col(label).cast("double").alias("t"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Each cell counts once for its true label and once for the predicted one.
    sides = F.array(
        F.struct(F.col("t").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("claimed")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("claimed")),
    )
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    per_label = (
        cells.select(hit.alias("hit"), F.inline(sides))
        .groupBy("c")
        .agg(
            F.sum(F.when(F.col("actual") > 0, F.col("hit")).otherwise(0)).alias("tp"),
            F.sum("actual").alias("actual"),
            F.sum("claimed").alias("claimed"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rated = per_label.select(
        "c",
        "tp",
        "actual",
        zero(F.try_divide("tp", "claimed")).alias("precision"),
        zero(F.try_divide("tp", "actual")).alias("recall"),
    ).withColumn(
        "f1",
        zero(F.try_divide(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall"))),
    )
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("actual")), F.sum("actual"))
    of_focus = lambda c: zero(F.max(F.when(F.col("c") == focus, F.col(c))))
    return rated.agg(
        F.try_divide(F.sum("tp"), F.sum("actual")).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        of_focus("precision").alias("focus_precision"),
        of_focus("recall").alias("focus_recall"),
    )


def regression_quality(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE and R2 (ML-08)."""
    return regression_metrics(df, label, prediction).select("rmse", "r2")
