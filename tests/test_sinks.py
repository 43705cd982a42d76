"""Writers and merge rules: read back what was written."""

from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from millrace.sinks import merge, messages, tables
from millrace.sources import prices, uploads, warehouse
from millrace.sources.tables import MissingLayer, read_feed, read_layer
from millrace.tenancy import Tenant

COLS = ["company_id", "factory_id", "region"]
DATA = [("A A", "A1", "x", 1), ("A A", "A1", "y", 2), ("A A", "A2", "x", 3), ("B", "B1", "x", 4)]
SCHEMA = "company_id string, factory_id string, region string, v int"


def read(spark, path):
    return sorted((r.company_id, r.factory_id, r.region, r.v) for r in spark.read.parquet(path).collect())


def test_tenant_run_replaces_only_that_tenant(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(rows(DATA, SCHEMA), path, COLS)
    assert read(spark, path) == sorted(DATA)
    # The new run has no region y any more: the old partition must go.
    tables.write_partitioned(rows([("A A", "A1", "x", 9)], SCHEMA), path, COLS, Tenant("A A", "A1"))
    assert read(spark, path) == [("A A", "A1", "x", 9), ("A A", "A2", "x", 3), ("B", "B1", "x", 4)]
    tables.write_partitioned(rows([("A A", "A9", "z", 5)], SCHEMA), path, COLS, Tenant("A A"))
    assert read(spark, path) == [("A A", "A9", "z", 5), ("B", "B1", "x", 4)]


def test_older_layout_does_not_survive(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows(DATA, SCHEMA).write.partitionBy("region").parquet(path)
    tables.write_partitioned(rows(DATA[:2], SCHEMA), path, COLS, Tenant("A A", "A1"))
    assert read(spark, path) == sorted(DATA[:2])
    tables.write_partitioned(rows(DATA, SCHEMA), path, COLS)
    assert read(spark, path) == sorted(DATA)


def test_missing_partition_column(rows, tmp_path):
    with pytest.raises(ValueError, match="region"):
        tables.write_partitioned(rows(DATA, SCHEMA).drop("region"), str(tmp_path / "t"), COLS)


def test_rewrite_in_place(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(rows(DATA, SCHEMA), path, COLS)
    tables.rewrite_in_place(spark.read.parquet(path).withColumn("v", F.col("v") * 10), path, COLS)
    assert [r[3] for r in read(spark, path)] == [10, 20, 30, 40]


def test_raw_write_keeps_other_tenants(spark, tmp_path):
    path = str(tmp_path / "orders")
    for tenant in (Tenant("A", "A1"), Tenant("B", "B1"), Tenant("A", "A1")):
        df = spark.createDataFrame([("o1", "Cairo")], "order_id string, delivery_governorate string")
        tables.write_raw(df, path, "orders", tenant)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.filter("loaded_at IS NULL").count() == 0


def test_layer_error_names_the_job(spark, tmp_path):
    with pytest.raises(MissingLayer, match="run the cleaning job first"):
        read_layer(spark, str(tmp_path), "nothing", "cleaning")


def test_feed_reads_by_name(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("quantity_tons,order_id,is_delayed,order_date\n12.5,o1,True,2024-01-02\nbad,o2,,\n")
    got = [tuple(r) for r in read_feed(spark, str(path), "orders").collect()]
    assert got == [(12.5, "o1", True, date(2024, 1, 2)), (None, "o2", None, None)]


def test_replace_tenants(rows, collect):
    new = rows([("A A", "A1", "z", 7)], SCHEMA)
    got = collect(merge.replace_tenants(rows(DATA, SCHEMA), new), "v")
    assert [r["v"] for r in got] == [3, 4, 7]


def test_align(rows, collect):
    target = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("flag", T.IntegerType()), T.StructField("k", T.StringType())])
    df = rows([("a", date(2024, 5, 1), True, 1), ("a", date(2023, 5, 1), False, 2)], "k string, date date, flag boolean, extra int")
    assert collect(merge.align(df, target, ["k"])) == [{"year": 2023, "flag": 0, "k": "a"}]


def test_insert_ignore_and_upsert(rows, collect):
    target = rows([("a", 1.0)], "k string, x double")
    new = rows([("a", 9.0), ("b", float("nan")), ("b", 5.0), ("c", 3.0)], "k string, x double")
    taken = merge.insert_ignore(target, new, ["k"])
    assert [(r["k"], r["x"]) for r in collect(taken, "k")] == [("b", None), ("c", 3.0)]
    assert merge.insert_counts(new, taken).first().asDict() == {"inserted": 2, "offered": 4, "skipped": 2}
    fresh = new.filter("k <> 'b'")
    assert [(r["k"], r["x"]) for r in collect(merge.upsert(target, fresh, ["k"]), "k")] == [("a", 9.0), ("c", 3.0)]
    assert [(r["k"], r["x"]) for r in collect(merge.upsert(target, fresh, ["k"], update=False), "k")] == [("a", 1.0), ("c", 3.0)]


def test_envelope(spark, collect):
    df = spark.createDataFrame([(None, "b"), ("Cairo", "a")], "delivery_governorate string, order_id string")
    got = collect(messages.envelope(df, "orders", order=["order_id"]).selectExpr("key", "get_json_object(value, '$.event_id') AS id"), "id")
    assert got == [{"key": "Cairo", "id": "ORD-000001"}, {"key": "unknown", "id": "ORD-000002"}]


def test_publish_to_files(spark, tmp_path):
    df = spark.createDataFrame([("k", "{}")], "key string, value string")
    messages.publish(df, "json", path=str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_dead_letter_keeps_every_record(spark, tmp_path):
    path = str(tmp_path / "dead")
    tables.dead_letter(spark.range(1200), path, "t", "x" * 500)
    back = spark.read.json(path)
    assert back.count() == 1200 and back.selectExpr("min(length(error))").first()[0] == 500


def test_upload_rules(spark, rows):
    factories = rows([("A", "A1"), ("B", "B1")], "company_id string, factory_id string")
    cols = uploads.UPLOAD_REQUIRED["shipments"]
    good = rows([tuple(["s1"] + ["v"] * (len(cols) - 1))], ", ".join(f"{c} string" for c in cols)).withColumn("company_id", F.lit("EVIL"))
    empty = good.withColumn("factory_id", F.lit("A1")).limit(0)
    taken = uploads.take_upload(good, "shipments", Tenant("A", "A1"), factories, empty)
    assert taken.first().company_id == "A"
    with pytest.raises(uploads.UploadRejected, match="does not belong"):
        uploads.take_upload(good, "shipments", Tenant("A", "B1"), factories, empty)
    with pytest.raises(uploads.UploadRejected, match="weight_tons"):
        uploads.validate(good.drop("weight_tons"), "shipments")
    with pytest.raises(uploads.UploadRejected, match="empty"):
        uploads.validate(good.limit(0), "shipments")
    with pytest.raises(uploads.UploadRejected, match="unknown feed"):
        uploads.validate(good, "weather")


def test_warehouse_options_and_statements():
    w = warehouse.Warehouse("jdbc:postgresql://host/db", "u", "secret")
    assert "secret" not in repr(w)
    assert w.read_options("t", ("id", "0", "100", 8))["numPartitions"] == "8"
    assert "numPartitions" not in w.read_options("t")
    delete, insert, drop = warehouse.swap_statements("s.t", "s.t_stage", ["company_id", "factory_id", "v"])
    assert delete.startswith("DELETE FROM s.t t WHERE EXISTS") and "s.factory_id = t.factory_id" in delete
    assert insert == "INSERT INTO s.t (company_id, factory_id, v) SELECT company_id, factory_id, v FROM s.t_stage"
    assert drop == "DROP TABLE s.t_stage"


def test_empty_harvest_fails(spark, rows):
    df = rows([("n/a",)], "rebar_egp string")
    with pytest.raises(prices.EmptyHarvest):
        prices.require_rows(prices.scrub_market(df))
    ok = prices.scrub_market(rows([("42000",)], "rebar_egp string"), today=F.lit("2024-01-01").cast("date")).first()
    assert (ok.date, ok.steel_price_egypt_egp, ok.usd_egp_rate) == (date(2024, 1, 1), 42000.0, None)


def test_checkpoint_dir_comes_from_the_session(spark):
    from millrace.session import shared_root

    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
