import math

import numpy as np
import pytest

from millrace.llm import ann


def exact(rows, every, k):
    """Brute force over (id, vector): {query: [(id, score)]}."""
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=np.float64)
    out = {}
    for q, a in good.items():
        if q % every == 0:
            scored = [(-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i) for i, b in good.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scored)[:k]]
    return out


def test_small_table_is_exact(files):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(4)]) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(200, 260)]  # copies
    rows += [(300, None), (301, [0.0] * 4), (302, [float("nan"), 1.0, 1.0, 1.0]), (303, [None, 1.0, 1.0, 1.0]),
             (304, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (310, [1.0, 2.0]), (320, []), (200, rows[3][1])]
    table = files([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, node string")
    got = {}
    for r in ann.neighbours(table, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows, 10, 5)
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        assert [i for _, i, _ in sorted(found)] == [i for i, _ in want[q]]
        assert np.allclose([s for _, _, s in sorted(found)], [s for _, s in want[q]], atol=1e-12)


@pytest.mark.parametrize("rows,n", [([], 0), ([(0, [1.0, 0.0])], 0), ([(0, [1.0, 0.0]), (7, [0.0, 1.0])], 1)])
def test_few_vectors(files, rows, n):
    table = files(rows, "vec_id long, embedding array<float>", parts=1)
    assert ann.neighbours(table).count() == n


def test_query_from_outside_the_index(files):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(4)]) for i in range(60)]
    sound = ann.usable(files(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    nodes = ann.nodes_of(sound, 6)
    asked = ann.usable(files([(1000, [1.0, 0.5, 0.0, 0.0])], "vec_id long, embedding array<float>", "q"), "vec_id", "embedding")
    from pyspark.sql import functions as F

    queries = asked.select(F.col("id").alias("query_id"), "vector", "norm", F.lit("none").alias("key"))
    got = [r.vec_id for r in ann.search(queries, nodes, ann.build(nodes), 5).orderBy("rank").collect()]
    want = exact([*rows, (1000, [1.0, 0.5, 0.0, 0.0])], 1000, 5)[1000]
    assert got == [i for i, _ in want]


def test_recall_on_the_test_table(spark, sf_dir):
    from millrace.llm.queries import QUERIES
    from millrace.llm.texts import table

    rows = table(spark, sf_dir, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    norm, found = np.linalg.norm(x, axis=1), {}
    for r in QUERIES["op2_nn_descent"](spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for at in np.flatnonzero(ids % 50 == 0):
        score = x @ x[at] / norm / norm[at]
        score[at] = -2
        best = set(ids[np.lexsort((ids, -score))[:5]].tolist())
        hits.append(len(best & found[int(ids[at])]) / 5)
    assert np.mean(hits) >= 0.9


@pytest.mark.parametrize("size", [500, 2000])
def test_descent_finds_what_small_leaves_do_not(files, monkeypatch, size):
    """Leaves of 24 in two orders hold few of the neighbours, so the rounds have to find them."""
    monkeypatch.setattr(ann, "LEAF", 24)
    monkeypatch.setattr(ann, "ORDERS", 2)
    x = np.random.default_rng(7).standard_normal((size, 8)).astype(np.float32)
    sound = ann.usable(files([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    nodes = ann.nodes_of(sound, 6)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    best = np.argsort(-near, axis=1)[:, :5]

    def recall(graph):
        links = {(r.u, r.v) for r in graph.select("u", "v").collect()}
        return np.mean([(u, int(v)) in links for u in range(size) for v in best[u]])

    print(size, recall(ann.first_graph(nodes, 10)), done := recall(ann.build(nodes, 10)))
    assert done >= 0.9 > recall(ann.first_graph(nodes, 10)) + 0.2
