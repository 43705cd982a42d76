"""Partitioned Parquet writes."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.dates import stamp
from millrace.schemas import RAW_PARTITION, TENANT_KEYS
from millrace.session import cut_lineage
from millrace.tenancy import Tenant, tag


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _children(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """Partition folders below a path as (key, value, full path)."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = []
    for status in fs.listStatus(hadoop_path):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            key, value = name.split("=", 1)
            found.append((key, unquote(value), status.getPath().toString()))
    return found


def _files(spark: SparkSession, path: str) -> set[str]:
    fs, hadoop_path = _fs(spark, path)
    found, walk = set(), fs.listFiles(hadoop_path, True)
    while walk.hasNext():
        found.add(walk.next().getPath().toString())
    return found


def _delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def drop_foreign_layout(spark: SparkSession, path: str, first_key: str) -> list[str]:
    """Remove top-level partition folders of another layout (SNK-03 A); Spark cannot read a mix."""
    foreign = [p for key, _value, p in _children(spark, path) if key != first_key]
    for p in foreign:
        _delete(spark, p)
    return foreign


def _tenant_folders(spark: SparkSession, path: str, tenant: Tenant) -> list[str]:
    companies = [p for _k, value, p in _children(spark, path) if value == tenant.company_id]
    if tenant.company_wide:
        return companies
    return [p for c in companies for _k, value, p in _children(spark, c) if value == tenant.factory_id]


def spread(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Gather rows by partition value so that each folder gets few files, while adaptive execution
    splits the value that holds a large part of all rows."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], tenant: Tenant | None = None) -> None:
    """Standard table write (SNK-02, SNK-03, SNK-15).

    A full run, or a table without tenant partitions, overwrites the whole root, which also removes
    any older layout. A tenant run replaces the partitions it writes and then removes the files of
    that tenant that the new run no longer has; other tenants stay, and a failed run leaves the old
    rows in place.
    """
    missing = [c for c in partition_cols if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} are not among {df.columns}")
    spark = df.sparkSession
    writer = spread(df, partition_cols).write.mode("overwrite").partitionBy(*partition_cols)
    if tenant is None or not tenant.company_id or partition_cols[:2] != TENANT_KEYS:
        writer.option("partitionOverwriteMode", "static").parquet(path)
        return
    drop_foreign_layout(spark, path, partition_cols[0])
    before = {f for folder in _tenant_folders(spark, path, tenant) for f in _files(spark, folder)}
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    after = {f for folder in _tenant_folders(spark, path, tenant) for f in _files(spark, folder)}
    for stale in before & after:
        _delete(spark, stale)


def write_raw(df: DataFrame, path: str, feed: str, tenant: Tenant, at=None) -> None:
    """Raw layer (SNK-01): tenant tag and load time, one optional partition column.

    The tenant leads the layout, so loading one tenant cannot touch another.
    """
    stamped = stamp(tag(df, tenant.company_id, tenant.factory_id, keep_existing=True), at=at)
    extra = [RAW_PARTITION[feed]] if RAW_PARTITION[feed] else []
    write_partitioned(stamped, path, TENANT_KEYS + extra, tenant)


def reload_global(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Truncate and load a table without tenants (SNK-07)."""
    cols = partition_cols or []
    writer = spread(df, cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*cols) if cols else writer).parquet(path)


def rewrite_in_place(df: DataFrame, path: str, partition_cols: list[str], tenant: Tenant | None = None) -> DataFrame:
    """Overwrite a table that the frame itself reads (SNK-14): the frame is checkpointed first."""
    fixed = cut_lineage(df)
    write_partitioned(fixed, path, partition_cols, tenant)
    return fixed


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def dead_letter(df: DataFrame, path: str, table: str, error: object) -> None:
    """Append rejected records as JSON lines (SNK-10): all of them, written by the executors.

    ``error`` is that of all records or the column ``__error``, which is then no part of the record.
    """
    df.select(
        F.current_timestamp().alias("ts"),
        F.lit(table).alias("table"),
        (error if isinstance(error, Column) else F.lit(str(error))).alias("error"),
        F.to_json(F.struct(*[c for c in df.columns if c != "__error"]), {"ignoreNullFields": "false"}).alias("record"),
    ).write.mode("append").json(path)
