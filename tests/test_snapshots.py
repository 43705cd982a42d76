import time

import pytest
from pyspark.sql import functions as F

from millrace.sinks import snapshots
from millrace.tenancy import Tenant

SCHEMA = "company_id string, factory_id string, id long, value double"
ZONES = ["company_id", "factory_id"]


@pytest.fixture
def table(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    data = [(c, f"{c}_{f}", 100 * i + 10 * f + n, float(n)) for i, c in enumerate("ABCD") for f in range(2) for n in range(5)]
    df = rows(data, SCHEMA)
    # one file per tenant, so that it shows which ones a write touches
    snapshots.replace_all(df.filter("company_id = 'A' AND factory_id = 'A_0'"), path, ZONES)
    for c in "ABCD":
        for f in range(2):
            if (c, f) != ("A", 0):
                snapshots.append_rows(df.filter(f"factory_id = '{c}_{f}'"), path)
    return path, data


def content(spark, path, **kw):
    return sorted((tuple(r) for r in snapshots.read_snapshot(spark, path, **kw).collect()), key=str)


def files(spark, path):
    return {r.file for r in snapshots.snapshot(spark, path).files(spark).collect()}


def test_readers_see_one_version(spark, rows, table):
    path, data = table
    reader = snapshots.read_snapshot(spark, path)
    before, version = files(spark, path), snapshots.versions(spark, path)[-1]
    new = [("B", "B_1", 999, None)]
    snapshots.replace_tenant(rows(new, SCHEMA), path, Tenant("B", "B_1"))
    assert sorted((tuple(r) for r in reader.collect()), key=str) == sorted(data, key=str)
    assert content(spark, path, version=version) == sorted(data, key=str)
    assert content(spark, path) == sorted([r for r in data if r[1] != "B_1"] + new, key=str)
    assert content(spark, path, tenant=Tenant("B", "B_1")) == new
    assert len(before - files(spark, path)) == 1 and len(files(spark, path) & before) == 7


def test_a_killed_write_leaves_the_old_rows(spark, rows, table):
    path, data = table
    bad = rows([("B", "B_1", 1, 1.0)], SCHEMA).withColumn("value", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        snapshots.replace_tenant(bad, path, Tenant("B", "B_1"))
    assert content(spark, path) == sorted(data, key=str)


def test_two_writers(spark, rows, table, monkeypatch):
    path, data = table
    stale = snapshots.snapshot(spark, path)
    snapshots.append_rows(rows([("Z", "Z_0", 1, 1.0)], SCHEMA), path)
    monkeypatch.setattr(snapshots, "snapshot", lambda *a: stale)
    with pytest.raises(snapshots.Conflict):
        snapshots.append_rows(rows([("Y", "Y_0", 1, 1.0)], SCHEMA), path)
    monkeypatch.undo()
    assert content(spark, path) == sorted([*data, ("Z", "Z_0", 1, 1.0)], key=str)


@pytest.mark.parametrize("update", [True, False])
def test_merge_rewrites_touched_files_only(spark, rows, table, update):
    path, data = table
    before = files(spark, path)
    new = [("C", "C_0", 201, -1.0), ("C", "C_0", 5000, -2.0), ("C", "C_0", None, -3.0)]
    snapshots.merge_rows(rows(new, SCHEMA), path, ["id"], update=update)
    gone = before - files(spark, path)
    want = {r[2]: r for r in data} | {r[2]: r for r in new if update or r[2] != 201}
    assert content(spark, path) == sorted(want.values(), key=str)
    assert len(gone) == int(update)


def test_statistics_without_a_second_scan(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = rows([("A", "A_0", 1, None), ("A", "A_0", None, 2.0), ("B", "B_0", 3, 4.0)], SCHEMA)
    snapshots.replace_all(df, path, ZONES, {"large": F.count_if(F.col("value") > 3), "mean": F.avg("value")})
    snapshots.append_rows(df.limit(0), path, {"mean": F.avg("value")})
    first, second = snapshots.statistics(spark, path).orderBy("version").collect()
    assert first.rows == 3 and first.nulls == {"company_id": 0, "factory_id": 0, "id": 1, "value": 1}
    assert first.measures == {"large": 1.0, "mean": 3.0}
    assert second.rows == 0 and second.measures == {"mean": None} and len(content_or_empty(spark, path)) == 3


def content_or_empty(spark, path):
    return snapshots.read_snapshot(spark, path).collect()


def test_old_versions_expire(spark, rows, table):
    path, data = table
    held = snapshots.versions(spark, path)
    assert snapshots.expire(spark, path, 0) == [] and snapshots.versions(spark, path) == held
    snapshots.replace_tenant(rows([("A", "A_0", 7, 7.0)], SCHEMA), path, Tenant("A", "A_0"))
    now = content(spark, path)
    gone = snapshots.expire(spark, path, int(time.time() * 1000) + 10_000)
    assert snapshots.versions(spark, path) == [held[-1] + 1] and content(spark, path) == now
    assert sum(g.startswith("data/") for g in gone) == 1


def test_other_columns_are_refused(rows, table):
    with pytest.raises(ValueError, match="columns"):
        snapshots.append_rows(rows([(1,)], "id long"), table[0])


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, str(tmp_path / "none"))
