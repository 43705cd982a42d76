import pytest
from pyspark.sql import functions as F

from millrace.sinks.merge import insert_ignore
from millrace.sources import keys
from millrace.tenancy import Tenant

FILES, ROWS = 20, 6000


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Two tenants; each file of the first holds its own range of ids, some of them null."""
    root = str(tmp_path_factory.mktemp("raw"))
    df = spark.range(FILES * ROWS, numPartitions=FILES).select(
        F.when(F.col("id") % 1000 != 7, F.concat(F.lit("o"), F.col("id").cast("string"))).alias("order_id"), F.col("id").alias("v")
    )
    for company, part in (("A B+%", df), ("C", df.limit(100))):
        tagged = part.withColumns({"company_id": F.lit(company), "factory_id": F.lit("F 1")})
        tagged.write.mode("append").partitionBy("company_id", "factory_id").parquet(f"{root}/orders")
    keys.index_files(spark, f"{root}/orders", ["order_id"], f"{root}/index")
    return f"{root}/orders", f"{root}/index"


def upload(spark, ids, company="A B+%"):
    return spark.createDataFrame([(i, n, company, "F 1") for n, i in enumerate(ids)], "order_id string, v long, company_id string, factory_id string")


def test_an_upload_opens_few_files_and_gives_the_same_rows(spark, raw):
    table, index = raw
    ids = [f"o{i}" for i in (5, 17, ROWS * 3 + 1, FILES * ROWS - 1)] + ["new1", "new1", None, "o7"]
    new = upload(spark, ids)
    held = keys.possible_rows(spark, new, table, ["order_id"], index)
    assert 3 <= len(held.inputFiles()) <= 5
    key = ["company_id", "factory_id", "order_id"]
    got, want = (insert_ignore(old, new, key).select("order_id", "v") for old in (held, spark.read.parquet(table)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3


def test_no_key_is_missed(spark, raw):
    table, index = raw
    ids = [f"o{i}" for i in range(0, FILES * ROWS, 331) if i % 1000 != 7]
    held = keys.possible_rows(spark, upload(spark, ids), table, ["order_id"], index)
    assert held.filter(F.col("order_id").isin(ids) & (F.col("company_id") != "C")).count() == len(ids)


def test_few_files_are_read_in_vain(spark, raw):
    table, index = raw
    strangers = upload(spark, [f"x{i}" for i in range(2000)])
    met = keys.may_hold(spark, strangers.limit(10), ["order_id"], index).count()
    assert met <= 8  # of 20 files, by ten keys
    assert keys.may_hold(spark, upload(spark, ["o5"], "other"), ["order_id"], index).count() == 0
    assert keys.possible_rows(spark, upload(spark, ["o5"], "other"), table, ["order_id"], index).count() == 0


def test_files_after_the_index_are_read_and_can_be_added(spark, raw, tmp_path):
    table, index = (str(tmp_path / n) for n in ("orders", "index"))
    upload(spark, ["a", "b"]).write.partitionBy("company_id", "factory_id").parquet(table)
    keys.index_files(spark, table, ["order_id"], index)
    upload(spark, ["c"]).write.mode("append").partitionBy("company_id", "factory_id").parquet(table)
    found = lambda: sorted(r.order_id for r in keys.possible_rows(spark, upload(spark, ["c"]), table, ["order_id"], index).collect())
    assert found() == ["c"]
    keys.index_files(spark, table, ["order_id"], index)
    assert found() == ["c"]
    size = spark.read.parquet(index).count()
    keys.index_files(spark, table, ["order_id"], index)
    assert spark.read.parquet(index).count() == size


def test_ledger(spark, rows, tmp_path):
    ledger, tenant = str(tmp_path / "ledger"), Tenant("A", "F")
    df = rows([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    assert not keys.taken_before(spark, df, "orders", tenant, ledger)
    keys.note_taken(df, "orders", tenant, ledger)
    same = df.select("b", "a").orderBy(F.desc("a")).withColumn("company_id", F.lit("Z"))
    assert keys.taken_before(spark, same, "orders", tenant, ledger)
    others = [df.distinct(), df.withColumn("b", F.coalesce("b", F.lit("null"))), df.withColumnRenamed("b", "c"), df.limit(0)]
    assert not any(keys.taken_before(spark, o, "orders", tenant, ledger) for o in others)
    assert not keys.taken_before(spark, df, "market", tenant, ledger)
    assert not keys.taken_before(spark, df, "orders", Tenant("A", "G"), ledger)
