import hashlib
import random

import pytest

from millrace.llm import pieces
from millrace.llm.queries import piece_model


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_chunks_give_the_library_ids(model):
    import numpy as np

    rng, table = random.Random(3), pieces.ChunkTable(piece_model(), remembered=500)
    texts = ["".join(rng.choice(" \n\t\r▁ab.é한\x00<s>0　") for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "  a  b ", "a" * 3000, "word " * 5000, "<unk><0x0A>"]
    got = [np.frombuffer(x, dtype=np.int32).tolist() for x in table.encode(texts)]
    assert got == [model.encode(t) for t in texts]


def test_query_is_the_library(spark, sf_dir, model):
    from millrace.llm.queries import QUERIES
    from millrace.llm.texts import table

    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op10_sentencepiece"](spark, sf_dir).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert len(got) == len(texts)
    for r in got:
        ids = model.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))


def test_null_empty_and_clashing(files, model):
    rows = files([(1, None, 5), (None, "", 6), (2, "hi you", 7), (2, "hi you", 7)], "doc_id long, text string, ids int")
    got = sorted((r.text or "", r.ids, r.decoded) for r in pieces.tokenize(rows, piece_model()).collect())
    assert got == [("", [], ""), ("", [], ""), *[("hi you", model.encode("hi you"), "hi you")] * 2]
    assert pieces.digests(rows.limit(0), piece_model()).count() == 0


def test_functions_alone(files, model):
    from pyspark.sql import functions as F

    rows = files([("a b",), (None,)], "text string")
    got = rows.select(F.coalesce("text", F.lit("")).alias("t")).select("t", pieces.encoder(piece_model())("t").alias("ids"))
    back = got.select("t", pieces.decoder(piece_model())("ids").alias("d")).collect()
    assert all(r.t == r.d for r in back)


def mixed_texts():
    rng = random.Random(5)
    common = [f"word{i}" for i in range(30)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.9 else f"rare{rng.random()}" for _ in range(rng.randint(0, 30))) for _ in range(300)]
    line = "=" * 5000
    return [*texts, *texts[:40], *[f"{line} {c} \n{line}" for c in common * 3], "", " ", "  a ▁ b  ", "x" * 100_000, "word1 " * 50_000]


@pytest.mark.parametrize("head", [0, 8, 40, 10**6])
def test_table_and_head_give_the_library_ids(files, model, head):
    texts = mixed_texts()
    rows = files([(i, t, i % 3) for i, t in enumerate(texts)], "doc_id long, text string, row int", parts=4)
    if head == 8:
        rows = rows.withColumn("row", rows.row * 1).distinct()  # no scan of files
    got = {r.doc_id: r for r in pieces.tokenize(rows, piece_model(), head=head).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = model.encode(text)
        assert (got[i].ids, got[i].decoded, got[i].text, got[i].row) == (ids, model.decode(ids), text, i % 3)


def test_texts_stay_in_the_task_that_reads_them(files, model):
    rows = files([(i, t) for i, t in enumerate(mixed_texts())], "doc_id long, text string", parts=4)
    made = pieces.tokenize(rows, piece_model(), head=8)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert all(r.ids == model.encode(r.text) for r in made.collect())


def test_each_recurring_chunk_is_segmented_once(files):
    texts = mixed_texts()
    rows = files([(t,) for t in texts], "text string", parts=4)
    counts = pieces.counted_chunks(rows, piece_model())
    table = pieces.segmented(counts, piece_model())
    cutter, want = pieces.ChunkTable(piece_model()), {}
    for text in texts:
        for chunk in cutter.chunks(text):
            want[chunk] = want.get(chunk, 0) + 1
    assert sorted((r.chunk, r.n) for r in counts.collect()) == sorted(want.items())
    want = {c: n for c, n in want.items() if n > 1}
    assert sorted((r.chunk, r.n) for r in table.collect()) == sorted(want.items())
    head = {r.chunk for r in pieces.head_of(table, 40).collect()}
    assert 0 < len(head) <= 40 and max(map(len, head)) <= pieces.HEAD_CHARS
    assert max(n for c, n in want.items() if len(c) <= pieces.HEAD_CHARS and c not in head) <= min(want[c] for c in head)
    assert pieces.head_of(table, 0).count() == 0
