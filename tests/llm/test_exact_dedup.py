import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup

ROWS = [
    (3, "a b"), (1, "ab"), (2, " a b "), (None, "a  b  c"), (7, ""), (8, None), (9, "  "), (1, "ab"), (5, "zz"), (6, "z z"),
    (None, "a b"), (10, "x" * 200_000), (11, "x" * 100_000 + " " + "x" * 100_000),
]
WANT = {
    (3, 2, 5, False), (1, 2, 5, False), (2, 2, 5, True), (None, None, 1, True), (None, 2, 5, False), (7, 9, 3, False),
    (8, 9, 3, False), (9, 9, 3, True), (5, 6, 2, False), (6, 6, 2, True), (10, 11, 2, False), (11, 11, 2, True),
}


def test_query(same_as_sql):
    same_as_sql("op1_exact_dedup")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.lit("x"), lambda t: F.length(t).cast("string")])
def test_decisions_whatever_the_digest(docs, digest):
    """Digests that collide are told apart on the bytes; several batches give what one gives."""
    got = exact_dedup.assign(docs(ROWS, parts=4), digest, maxFilesPerTrigger="1")
    rows = [tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert len(rows) == len(ROWS) and set(rows) == WANT


def test_equal_rows_keep_one(docs):
    got = exact_dedup.duplicates(docs([(4, "same")] * 5)).collect()
    assert sorted(r.kept for r in got) == [False] * 4 + [True] and {r.group_size for r in got} == {5}


def test_empty_table(docs):
    assert exact_dedup.duplicates(docs([])).count() == 0


def test_stream_goes_on_with_new_files(spark, docs, tmp_path):
    table, keys, out = docs([(1, "a"), (2, "b")]), str(tmp_path / "keys"), str(tmp_path / "out")
    for _ in range(2):
        exact_dedup.append_keys(table, keys)
        exact_dedup.advance(spark, keys, str(tmp_path / "checkpoint"), out)
    assert {r.group_size for r in exact_dedup.states(spark, out).collect()} == {2}


def test_clashing_columns(files):
    rows = files([(1, "a", "k", 5), (2, "a", "k", 6)], "doc_id long, text string, digest string, group_size long")
    assert {tuple(r) for r in exact_dedup.duplicates(rows).select("doc_id", "keep_id", "group_size").collect()} == {(1, 1, 2), (2, 1, 2)}
