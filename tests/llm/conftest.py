import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def files(spark, tmp_path):
    """A table written to files and read again, as the operators get theirs."""

    def make(rows, schema, name="table", parts=2):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def docs(files):
    """Documents from (doc_id, text)."""
    return lambda rows, **more: files([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS, "documents", **more)


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir):
    """A registered query against its SQL on the smallest tables."""

    def run(name):
        from millrace.llm import queries

        con = duckdb.connect()
        for table in "documents embeddings pages benchmark labels conversations".split():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        df = queries.QUERIES[name](spark, sf_dir)
        answer = con.execute(queries.ORACLES[name])
        columns = [c[0] for c in answer.description]
        assert sorted(columns) == sorted(df.columns)
        want = sorted(str(tuple(v for _, v in sorted(zip(columns, row)))) for row in answer.fetchall())
        got = sorted(str(tuple(row[c] for c in sorted(columns))) for row in df.collect())
        assert got == want and got

    return run
