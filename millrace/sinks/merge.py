"""Merge rules as DataFrames: what the target holds after a write.

Each function is lazy and takes the current target, so the same rule serves a Parquet rewrite, a
staged swap and a test against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.series import first_rows
from millrace.schemas import TENANT_KEYS
from millrace.tenancy import Tenant


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key (SET-03), the first under a total order.

    The rank filter is applied per task before the shuffle, so a key with very many copies sends
    one row per task.
    """
    return first_rows(df, keys, order or [c for c in df.columns if c not in keys], 1)


def align(df: DataFrame, target: T.StructType, keys: list[str] | None = None, date_col: str = "date") -> DataFrame:
    """Shape a frame to a target table (SNK-06).

    Columns come in target order; those the target lacks are dropped; ``year`` is derived from the
    date; booleans become integers where the target holds integers; one row per key remains.
    """
    if "year" in target.fieldNames() and "year" not in df.columns and date_col in df.columns:
        df = df.withColumn("year", F.year(date_col))
    whole = (T.IntegerType, T.LongType, T.ShortType)
    cols = []
    for field in target.fields:
        if field.name not in df.columns:
            continue
        is_bool = isinstance(df.schema[field.name].dataType, T.BooleanType)
        value = F.col(field.name)
        cols.append(value.cast(field.dataType).alias(field.name) if is_bool and isinstance(field.dataType, whole) else value)
    shaped = df.select(*cols)
    present = [k for k in keys or [] if k in shaped.columns]
    return one_per_key(shaped, present) if present else shaped


def bools_to_int(df: DataFrame) -> DataFrame:
    """Booleans as integers for the warehouse mirror (PRJ-10)."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in flags}) if flags else df


def replace_tenants(target: DataFrame, new: DataFrame) -> DataFrame:
    """Target after replacing every tenant present in ``new`` (SNK-05)."""
    touched = new.select(*TENANT_KEYS).distinct()
    return target.join(touched, TENANT_KEYS, "left_anti").select(*target.columns).unionByName(new, allowMissingColumns=True)


def replace_tenant(target: DataFrame, new: DataFrame, tenant: Tenant) -> DataFrame:
    """Target after replacing one known tenant (SNK-08): a filter on its partition, no join."""
    others = target.filter(~F.coalesce(tenant.predicate(), F.lit(False)))
    return others.unionByName(new, allowMissingColumns=True)


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` that enter the target: keys already there win (SNK-12). NaN becomes null."""
    floats = [f.name for f in new.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    clean = new.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else new
    return one_per_key(clean, keys).join(target.select(*keys), keys, "left_anti").select(*new.columns)


def insert_counts(new: DataFrame, accepted: DataFrame) -> DataFrame:
    """Rows offered, inserted and skipped (SNK-12)."""
    offered = new.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = accepted.agg(F.count(F.lit(1)).alias("inserted")).withColumn("offered", offered)
    return counts.withColumn("skipped", F.col("offered") - F.col("inserted"))


def upsert(target: DataFrame, new: DataFrame, keys: list[str], update: bool = True) -> DataFrame:
    """Target after insert-or-update on the key; ``update=False`` keeps existing rows (SNK-13).

    A union and one ranked pass: the preferred source per key survives.
    """
    both = target.withColumn("_src", F.lit(1 if update else 0)).unionByName(
        new.withColumn("_src", F.lit(0 if update else 1))
    )
    rest = [c for c in target.columns if c not in keys]
    return first_rows(both, keys, ["_src", *rest], 1).drop("_src")
