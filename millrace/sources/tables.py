"""Batch scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.schemas import FEEDS, TENANT_KEYS
from millrace.tenancy import Tenant, scope


class MissingLayer(FileNotFoundError):
    """An earlier layer has not been written yet."""


def read_feed(spark: SparkSession, path: str, feed: str, infer: bool = False) -> DataFrame:
    """CSV feed with a header (SRC-01). The schema is declared, so the file is read once; ``infer``
    trades a second pass for files of unknown shape."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    # Read as text and cast by name: files may order their columns freely or lack optional ones,
    # and a bad value becomes null instead of failing the scan.
    text = reader.csv(path)
    typed = {f.name: f.dataType for f in FEEDS[feed].fields}
    return text.select(*[F.col(c).try_cast(typed[c]).alias(c) if c in typed else F.col(c) for c in text.columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works on any Hadoop file system, object stores included."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isFile()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table whose tenant columns are text, also where they come from folder names: ids such
    as 0012 and 12 stay two tenants, whatever Spark would infer from the folders."""
    found = spark.read.parquet(path)
    if all(f.dataType == T.StringType() for f in found.schema.fields if f.name in TENANT_KEYS):
        return found
    fields = [T.StructField(f.name, T.StringType()) if f.name in TENANT_KEYS else f for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_layer(
    spark: SparkSession, root: str, table: str, producer: str, tenant: Tenant | None = None
) -> DataFrame:
    """Layer table, with a clear error if the producing job has not run (SRC-02).

    A tenant scope filters the partition columns, so only that subtree is listed and read.
    """
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        raise MissingLayer(f"{path} does not exist; run the {producer} job first")
    df = read_table(spark, path)
    return df.transform(scope(tenant)) if tenant and tenant.company_id else df
