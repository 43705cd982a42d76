import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.toxicity import Model, maximal_segments


def brute(scores):
    """Maximal-scoring runs by definition: the best run, then those left and right of it."""
    best, at = 0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sum(scores[i:j]) > best + 1e-9:
                best, at = sum(scores[i:j]), (i, j)
    if at is None:
        return []
    i, j = at
    return brute(scores[:i]) + [(i, j, best)] + [(a + j, b + j, s) for a, b, s in brute(scores[j:])]


def test_segments_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = [float(x) if rng.random() < 0.4 else -0.5 for x in rng.uniform(0.1, 2.37, rng.integers(0, 25))]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        got = maximal_segments(hits, 0.5)
        want = brute(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_passage_spans_are_those_of_the_text():
    model = Model({"bad": 6.0, "İbad": 6.0}, 0.1, 1.0, 1e-3, 0.05, -3.0, 2.0)
    text = "İİ fine fine bad Bad, fine"
    scan = lambda t: model.scan(t, toxicity.Matcher(model.scores))
    passages = scan(text)["passages"]
    assert [text[p["start"] : p["stop"]] for p in passages] == ["bad Bad"]
    assert scan("fine abad")["passages"] == [] and scan("")["score"] < 0.1 < scan(text)["score"]


def learnt(files, n=240):
    rng = np.random.default_rng(4)
    texts = []
    for i in range(n):
        words = [f"w{rng.integers(0, 400)}" for _ in range(60)]
        if i % 6 == 0:
            for at in rng.integers(0, 60, 4):
                words[at] = rng.choice(["vile", "nasty"]) + rng.choice(["", "ness"])
        texts.append((i, " ".join(words), 5))
    labels = [(i, int(i % 6 == 0), "x") for i in range(n)] + [(None, 1, ""), (3, None, ""), (99_999, 1, "")]
    return files(texts, "doc_id long, text string, score int"), files(labels, "doc_id long, toxic int, text string", "labels")


def test_held_out_accuracy(files):
    docs, labels = learnt(files)
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == 240 and any(r.held_out for r in rows)
    assert all(r.predicted == (r.doc_id % 6 == 0) for r in rows if r.held_out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn_and_empty(files):
    docs, labels = learnt(files, 12)
    rows = toxicity.judge(docs, labels.filter("toxic = 0")).collect()
    assert {r.predicted for r in rows} == {0} and all(r.score < 1e-9 for r in rows)
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_null_and_repeated_rows(files):
    docs, labels = learnt(files)
    model = toxicity.fit(docs, labels)
    odd = files([(None, None), (1, ""), (2, "vile nasty vileness"), (2, "vile nasty vileness"), (3, "w1 " * 50_000)], "doc_id long, text string", "odd")
    got = sorted((r.score >= 0.7, len(r.passages)) for r in toxicity.score_documents(odd, model).collect())
    assert got == [(False, 0)] * 3 + [(True, 1)] * 2


def test_model_does_not_see_held_out_labels(files):
    docs, labels = learnt(files)
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (sorted(tuple(r) for r in toxicity.judge(docs, x).collect()) for x in (labels, turned))
    assert first == second


@pytest.mark.parametrize("y", [[0, 0, 1, 1], [0, 1, 0, 1]])
def test_logistic_is_finite(y):
    assert np.isfinite(toxicity.logistic(np.array([0.0, 0.0, 3.0, 4.0]), np.array(y, dtype=float))).all()
