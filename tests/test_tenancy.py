from millrace.tenancy import Tenant, run_scope, scope, scope_sizes, strip_reserved, tag, training_scope
import pytest

DATA = [("A", "A1", 1), ("A", "A1", 2), ("A", "A2", 1), ("B", "B1", 1)]
SCHEMA = "company_id string, factory_id string, k int"


def test_scopes(rows):
    df = rows(DATA, SCHEMA)
    assert df.transform(scope(Tenant("A", "A1"))).count() == 2
    assert df.transform(scope(Tenant("A", "ALL_FACTORIES"))).count() == 3
    assert df.transform(scope(Tenant("A"))).count() == 3
    with pytest.raises(ValueError):
        Tenant().predicate()


def test_run_scope_ignores_absent_columns(rows):
    df = rows(DATA, SCHEMA)
    assert run_scope(df, None, None).count() == 4
    assert run_scope(df, None, "A1").count() == 2
    assert run_scope(df.drop("factory_id"), "B", "A1").count() == 1


def test_tag_and_strip(rows):
    df = rows(DATA, SCHEMA)
    assert strip_reserved(df).columns == ["k"]
    assert {r.company_id for r in tag(df, "X", "Y").collect()} == {"X"}
    assert {r.company_id for r in tag(df, "X", "Y", keep_existing=True).collect()} == {"A", "B"}


@pytest.mark.parametrize("level, expected", [("factory", 2), ("company", 3), ("all", 4)])
def test_training_scope_is_the_callers(rows, level, expected):
    df = rows(DATA, SCHEMA)
    assert training_scope(df, Tenant("A", "A1"), level).count() == expected
    assert scope_sizes(df, Tenant("A", "A1")).first()[level] == expected
    with pytest.raises(ValueError):
        training_scope(df, Tenant("A", "A1"), "enough")


def test_tenant_ids_keep_their_text(rows, tmp_path, spark):
    from millrace.sinks.tables import write_partitioned
    from millrace.sources.tables import read_layer

    ids = [("0012", "1"), ("12", "1"), ("12", "01")]
    write_partitioned(rows([(*i, k) for k, i in enumerate(ids)], "company_id string, factory_id string, k int"), f"{tmp_path}/t", ["company_id", "factory_id"])
    back = read_layer(spark, str(tmp_path), "t", "test")
    assert sorted((r.company_id, r.factory_id) for r in back.collect()) == sorted(ids)
    assert [r.k for r in read_layer(spark, str(tmp_path), "t", "test", Tenant("0012", "1")).collect()] == [0]


def test_untagged_rows_need_a_tenant(rows, tmp_path):
    from millrace.sinks.tables import write_raw

    bare = rows([(1,)], "k int")
    with pytest.raises(ValueError, match="name a tenant"):
        write_raw(bare, str(tmp_path / "raw"), "orders", Tenant())


def test_scope_prunes_partitions(rows, tmp_path, spark):
    from millrace.sinks.tables import write_partitioned

    path = str(tmp_path / "t")
    write_partitioned(rows(DATA, SCHEMA), path, ["company_id", "factory_id"])
    plan = spark.read.parquet(path).transform(scope(Tenant("A", "A1")))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(company_id" in plan
