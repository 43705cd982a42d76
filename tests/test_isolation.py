import json

import pytest
from pyspark.sql import functions as F

from millrace.streaming.isolation import IsolatingSink
from millrace.tenancy import Tenant

TENANT = Tenant("A", "A_1")


def picky(condition):
    """A store that refuses rows, as a table with a constraint does."""

    def write(rows, folder):
        if not rows.filter(condition).isEmpty():
            raise ValueError(f"constraint {condition}")
        rows.write.mode("append").parquet(folder)

    return write


def test_one_bad_row_among_ten_thousand(spark, tmp_path):
    calls = []

    def write(rows, folder):
        calls.append(1)
        picky("id = 4711")(rows, folder)

    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT, write, "s1")
    for _ in range(2):  # a replay
        sink(spark.range(10_000), 0)
    assert len(calls) < 2 * 2 * 25
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 9_999 and stored.filter("id = 4711").isEmpty()
    dead = spark.read.json(str(tmp_path / "dead")).collect()
    assert [json.loads(r.record)["id"] for r in dead] == [4711] and dead[0].error == "constraint id = 4711"


def test_storage_errors_are_raised(spark, tmp_path):
    def write(rows, folder):
        raise OSError("No space left on device")

    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT, write, "s1")
    with pytest.raises(OSError):
        sink(spark.range(5), 0)
    assert not (tmp_path / "dead").exists()


def test_equal_bad_rows_and_empty_batches(spark, rows, tmp_path):
    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT, picky("v IS NULL"), "s1")
    sink(rows([(None,), (None,), (1,)], "v int"), 0)
    sink(rows([], "v int"), 1)
    assert spark.read.json(str(tmp_path / "dead")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out")).select("v", "batch_id").collect() == [(1, 0)]


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(3).write.parquet(source)
    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT)
    for checkpoint in ("a", "b", "b"):
        stream = spark.readStream.schema("id long").parquet(source)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 6 and stored.select("stream").distinct().count() == 2
    assert stored.groupBy("id").agg(F.count("*").alias("n")).filter("n <> 2").isEmpty()


def test_many_bad_rows_take_one_write(spark, tmp_path):
    calls = []

    def accept(batch):
        if any(i % 25 == 7 for i in batch.column("id").to_pylist()):
            raise ValueError("no sevens")

    def write(rows, folder):
        calls.append(1)
        rows.write.mode("append").parquet(folder)

    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT, write, "s1", accept)
    for _ in range(2):  # a replay
        sink(spark.range(10_000), 0)
    assert len(calls) == 2 and spark.read.parquet(str(tmp_path / "out")).count() == 9_600
    dead = spark.read.json(str(tmp_path / "dead"))
    assert dead.count() == 400 and {r.error for r in dead.collect()} == {"no sevens"}
    record = json.loads(dead.first().record)
    assert record["id"] % 25 == 7 and set(record) == {"id", "company_id", "factory_id", "created_at"}


def test_a_storage_error_in_a_check_is_raised(spark, tmp_path):
    def accept(batch):
        raise OSError("No space left on device")

    sink = IsolatingSink(str(tmp_path / "out"), str(tmp_path / "dead"), "t", TENANT, None, "s1", accept)
    with pytest.raises(Exception, match="No space left"):
        sink(spark.range(5), 0)
    assert not (tmp_path / "dead").exists()
