"""Tables as versions: one commit point, rewrites of touched files only, statistics taken by the write itself.

A table is a folder. Data files below ``data/<write>`` are never changed. ``files/<write>`` lists the files of a
version with their rows and the least and greatest value of each zone column. ``commits/<version>.json`` is
the one commit point: it is written beside and renamed, and a rename onto an existing version fails, so of two writers one
wins and the other raises ``Conflict``. A reader takes the newest commit and sees that version's files and no others,
whatever is being written. A write that dies leaves files that no commit names.

Rows are clustered by the zone columns, so a reader of one tenant opens the files whose zones may hold it, and a
refresh or merge rewrites those and keeps the rest as they are. ``replace_all`` can lay rows out along a curve through all
zone columns instead, so a range of any of them, such as the dates of a preset, opens few files (``read_ranges``).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.sinks.layout import along_curve
from millrace.sinks.tables import _delete, _fs, spread
from millrace.tenancy import Tenant

DIGITS = 12
FILE = "file string, rows long, low array<string>, high array<string>"


class Conflict(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class Snapshot:
    """A committed version of a table."""

    path: str
    version: int
    write: str
    at_ms: int
    zones: list[str]
    schema: str
    statistics: dict
    #: Number of the last batch added with one, carried from version to version.
    batch: int = -1

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FILE).parquet(f"{self.path}/files/{self.write}")

    def read(self, spark: SparkSession, files: DataFrame | None = None) -> DataFrame:
        """The rows of all files, or of some; their paths are collected, as by any scan of a folder."""
        chosen = self.files(spark) if files is None else files
        paths = [f"{self.path}/{r.file}" for r in chosen.select("file").orderBy("file").toLocalIterator()]
        kind = T.StructType.fromJson(json.loads(self.schema))
        return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, folder = _fs(spark, f"{path}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:DIGITS]) for n in names if len(n) == DIGITS + 5 and n[:DIGITS].isdigit() and n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The given or the newest version, None if there is none."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    text = spark.read.text(f"{path}/commits/{version:0{DIGITS}d}.json", wholetext=True).first()[0]
    return Snapshot(path=path, version=version, **json.loads(text))


def read_snapshot(spark: SparkSession, path: str, tenant: Tenant | None = None, version: int | None = None) -> DataFrame:
    """The rows of a version; of one tenant, from the files whose zones may hold it."""
    at = snapshot(spark, path, version)
    if at is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    if tenant is None or not tenant.company_id:
        return at.read(spark)
    return at.read(spark, at.files(spark).filter(may_hold(at.zones, tenant))).filter(tenant.predicate())


def may_hold(zones: list[str], tenant: Tenant) -> Column:
    """Whether a file's zones leave room for rows of the tenant; a column without values has no bounds and is passed over."""
    wanted = {"company_id": tenant.company_id} | ({} if tenant.company_wide else {"factory_id": tenant.factory_id})
    held = F.lit(True)
    for i, name in enumerate(zones):
        if name in wanted:
            held = held & F.coalesce((F.col("low")[i] <= wanted[name]) & (F.col("high")[i] >= wanted[name]), F.lit(False))
    return held


def read_ranges(spark: SparkSession, path: str, ranges: dict[str, tuple], version: int | None = None) -> DataFrame:
    """Rows whose columns lie in the given closed ranges (SRC-02, PRJ-11, TOP-05), from the files whose zones meet them all.

    An end of None is open. Values are of the column's type or text of it. A column that is no zone only filters rows.
    """
    at = snapshot(spark, path, version)
    if at is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    kind = T.StructType.fromJson(json.loads(at.schema))
    wanted = F.lit(True)
    for name, (low, high) in ranges.items():
        held = F.col(name).isNotNull()
        for end, beyond in ((low, F.col(name).__ge__), (high, F.col(name).__le__)):
            held = held if end is None else held & beyond(F.lit(end).cast(kind[name].dataType))
        wanted = wanted & held
    return at.read(spark, at.files(spark).filter(may_meet(at.zones, kind, ranges))).filter(wanted)


def may_meet(zones: list[str], kind: T.StructType, ranges: dict[str, tuple]) -> Column:
    """Whether a file's zones leave room for rows inside the ranges; a file without values in a column holds none."""
    met = F.lit(True)
    for i, name in enumerate(zones):
        if name in ranges:
            as_typed = lambda c: F.when(F.size(c) > i, c[i]).cast(kind[name].dataType)  # noqa: B023, E731
            low, high = ranges[name]
            bounds = as_typed(F.col("low")), as_typed(F.col("high"))
            met = met & bounds[0].isNotNull()
            met = met if low is None else met & (bounds[1] >= F.lit(low).cast(kind[name].dataType))
            met = met if high is None else met & (bounds[0] <= F.lit(high).cast(kind[name].dataType))
    return met


def _null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]


def _write(df: DataFrame, path: str, zones: list[str], measures: dict[str, Column], files: int | None = None) -> tuple[str, dict]:
    """Write the rows as new files; their number, nulls and measures are observed on the way out."""
    write, seen = uuid.uuid4().hex, Observation()
    taken = [m.alias(f"measure_{i}") for i, m in enumerate(measures.values())]
    if files and zones:
        out = along_curve(df, zones, files)
    else:
        out = spread(df, zones).sortWithinPartitions(*zones) if zones else df
    out.observe(seen, F.count(F.lit(1)).alias("rows"), *_null_counts(df), *taken).write.parquet(f"{path}/data/{write}")
    got = seen.get
    return write, {
        "rows": got["rows"], "nulls": {c: got[f"nulls_{i}"] for i, c in enumerate(df.columns)},
        "measures": {m: None if got[f"measure_{i}"] is None else float(got[f"measure_{i}"]) for i, m in enumerate(measures)},
    }


def _listed(spark: SparkSession, path: str, write: str, zones: list[str], schema: T.StructType) -> DataFrame:
    """Entries of the files of a write; only the zone columns are read."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    text = [F.col(z).cast("string") for z in zones]
    none = F.array().cast("array<string>")
    return spark.read.schema(schema).parquet(f"{path}/data/{write}").groupBy(
        F.concat(F.lit(f"data/{write}/"), name).alias("file")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.array(*[F.min(c) for c in text]) if text else none).alias("low"),
        (F.array(*[F.max(c) for c in text]) if text else none).alias("high"),
    )


def _commit(spark: SparkSession, path: str, version: int, write: str, entries: DataFrame, zones, schema, statistics, batch) -> Snapshot:
    entries.write.mode("overwrite").parquet(f"{path}/files/{write}")
    body = {"write": write, "at_ms": int(time.time() * 1000), "zones": zones, "schema": schema, "statistics": statistics, "batch": batch}
    jvm = spark._jvm.org.apache.hadoop.fs
    fs, beside = _fs(spark, f"{path}/commits/_{write}")
    out = fs.create(beside, True)
    out.write(json.dumps(body).encode())
    out.close()
    target = jvm.Path(f"{path}/commits/{version:0{DIGITS}d}.json")
    none = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    none[0] = jvm.Options.Rename.NONE
    context = jvm.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(target), none)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            fs.delete(beside, False)
            raise Conflict(f"version {version} of {path} was committed by another writer") from None
        raise
    return Snapshot(path=path, version=version, **body)


def _next(spark: SparkSession, df: DataFrame, path: str, base: Snapshot | None, kept: DataFrame | None, zones, measures, batch=None, files=None) -> Snapshot:
    """Commit the version after ``base``: the kept files and the rows as new ones."""
    if batch is None:
        batch = base.batch if base else -1
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    write, statistics = _write(df, path, zones, measures or {}, files)
    entries = _listed(spark, path, write, zones, schema)
    if kept is not None:
        entries = entries.unionByName(kept)
    return _commit(spark, path, base.version + 1 if base else 0, write, entries, zones, schema.json(), statistics, batch)


def _same_columns(base: Snapshot, df: DataFrame) -> DataFrame:
    """The rows with the table's columns in its order and types; others than these are an error."""
    kind = T.StructType.fromJson(json.loads(base.schema))
    if sorted(kind.names) != sorted(df.columns):
        raise ValueError(f"the table has the columns {kind.names}, the rows have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields])


def replace_all(
    df: DataFrame, path: str, zones: list[str], measures: dict[str, Column] | None = None, batch: int | None = None,
    curve_files: int | None = None,
) -> Snapshot:
    """A new version of these rows alone (SNK-02, SNK-15). ``measures`` are aggregates kept with its statistics.

    ``curve_files`` lays the rows out along a curve through all zone columns, in about so many files.
    """
    spark = df.sparkSession
    return _next(spark, df, path, snapshot(spark, path), None, zones, measures, batch, curve_files)


def append_rows(df: DataFrame, path: str, measures: dict[str, Column] | None = None, batch: int | None = None) -> Snapshot:
    """A new version with these rows added. A batch whose number is not above the last one's is a replay and adds nothing:
    the number is part of the commit, so rows and number arrive together or not at all."""
    spark = df.sparkSession
    base = snapshot(spark, path)
    if batch is not None and batch <= base.batch:
        return base
    return _next(spark, _same_columns(base, df), path, base, base.files(spark), base.zones, measures, batch)


def replace_tenant(df: DataFrame, path: str, tenant: Tenant, measures: dict[str, Column] | None = None) -> Snapshot:
    """A new version in which a tenant has these rows only (SNK-03, SNK-05).

    Files whose zones leave no room for the tenant stay; of the others, the rows of other tenants are written again.
    """
    spark = df.sparkSession
    base = snapshot(spark, path)
    touched = may_hold(base.zones, tenant)
    files = base.files(spark)
    others = base.read(spark, files.filter(touched)).filter(~F.coalesce(tenant.predicate(), F.lit(False)))
    return _next(spark, others.unionByName(_same_columns(base, df)), path, base, files.filter(~touched), base.zones, measures)


def merge_rows(df: DataFrame, path: str, keys: list[str], update: bool = True, measures: dict[str, Column] | None = None) -> Snapshot:
    """Insert or update by key (SNK-13, SNK-17); with ``update=False`` existing rows win.

    A semi join on the keys names the files that hold one of them. Only these are rewritten; without an update none is.
    ``df`` has one row for each key. Null keys match nothing.
    """
    spark = df.sparkSession
    base = snapshot(spark, path)
    new, files = _same_columns(base, df), base.files(spark)
    table = base.read(spark)
    if not update:
        fresh = new.join(table.select(*keys), keys, "left_anti").select(*new.columns)
        return _next(spark, fresh, path, base, files, base.zones, measures)
    held = table.select(*keys, F.col("_metadata.file_path").alias("__path")).join(new.select(*keys), keys, "left_semi")
    parts = F.slice(F.split("__path", "/"), -3, 3)
    touched = held.select(F.array_join(parts, "/").alias("file")).distinct()
    rewritten = files.join(touched, "file", "left_semi")
    stay = base.read(spark, rewritten).join(new.select(*keys), keys, "left_anti").select(*new.columns)
    return _next(spark, stay.unionByName(new), path, base, files.join(touched, "file", "left_anti"), base.zones, measures)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row per version, from the commits alone: rows written, nulls by column, measures (AGG-09, AGG-37)."""
    kind = "version long, at_ms long, rows long, nulls map<string,long>, measures map<string,double>"
    rows = [snapshot(spark, path, v) for v in versions(spark, path)]
    return spark.createDataFrame([(s.version, s.at_ms, s.statistics["rows"], s.statistics["nulls"], s.statistics["measures"]) for s in rows], kind)


def expire(spark: SparkSession, path: str, before_ms: int) -> list[str]:
    """Forget versions committed before that time, but for the newest one, and remove writes that no kept version names.

    Writes without a commit that are younger stay: their writer may be about to commit. A folder is removed by one call.
    """
    known = [snapshot(spark, path, v) for v in versions(spark, path)]
    old = [s for s in known[:-1] if s.at_ms < before_ms]
    kept = [s for s in known if s not in old]
    named = {s.write for s in kept}
    for s in kept:
        named |= {r[0] for r in s.files(spark).select(F.split("file", "/")[1]).distinct().toLocalIterator()}
    for s in old:
        _delete(spark, f"{path}/commits/{s.version:0{DIGITS}d}.json")
    gone = []
    for part in ("data", "files"):
        fs, folder = _fs(spark, f"{path}/{part}")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name not in named and (status.getModificationTime() < before_ms):
                fs.delete(status.getPath(), True)
                gone.append(f"{part}/{name}")
    return sorted(gone)
