import hashlib
import random

import numpy as np
import pytest

from millrace.llm import bpe_chunks
from millrace.llm.queries import QUERIES, word_model
from millrace.llm.texts import table


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_model())


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids


def test_joins_are_repaired(model):
    rng, encoder = random.Random(5), bpe_chunks.Encoder(word_model())
    for _ in range(3000):
        text = "".join(rng.choice("  abcABC.,'s\t\n1é漢́ \x1c<|endoftext|>") for _ in range(rng.randint(0, 60)))
        ends = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 9)))) + [len(text)]
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
        ids = encoder.numbers(encoder.joined([encoder.pieces(parts)])[0]).tolist()
        assert ids == ids_of(model, text), (text, parts)
        assert encoder.decode(ids) == model.decode(ids, skip_special_tokens=False)
    assert encoder.plain is not None
    for _ in range(3000):
        text = "".join(chr(rng.randint(0, 255)) if rng.random() < 0.5 else rng.choice("aB '<|endoftext|>\u0301") for _ in range(rng.randint(0, 40)))
        assert encoder.numbers(encoder.encode([text])[0]).tolist() == ids_of(model, text), text
    whole = "x" * 400 + "<|endoftext|>" + "Don't " * 50
    assert [encoder.numbers(x).tolist() for x in encoder.encode([whole, ""])] == [ids_of(model, whole), []]


class Counted:
    """A tokenizer that notes what it is given."""

    def __init__(self, model):
        self.model, self.given = model, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.model.encode_batch_fast(texts, **options)


def test_words_that_come_again_are_looked_up(model, monkeypatch):
    encoder = bpe_chunks.Encoder(word_model())
    encoder.model, encoder.plain = Counted(encoder.model), Counted(encoder.plain)
    texts = [f"Café don't {'The same words, ' * 500}{i} {'y' * 40}" for i in range(20)]
    whole = [ids_of(model, t) for t in texts]
    assert [encoder.numbers(x).tolist() for x in encoder.encode(texts)] == whole
    assert sum(map(len, encoder.model.given + encoder.plain.given)) < 2000  # of 160,000 characters
    assert all(len(word) <= bpe_chunks.SHORT for word in encoder.known)
    monkeypatch.setattr(bpe_chunks, "KNOWN", 3)
    assert [encoder.numbers(x).tolist() for x in encoder.encode(texts)] == whole and len(encoder.known) <= 3
    latin = [chr(i) for i in range(256)]
    pairs = [f"{a}{b}{c}" for a in latin for b in latin for c in ("", "'s1")]
    for at in range(0, len(pairs), 4096):
        some = pairs[at : at + 4096]
        found = model.encode_batch_fast(some, add_special_tokens=False)
        assert [encoder.numbers(x).tolist() for x in encoder.encode(some)] == [f.ids for f in found]


def test_chunks_depend_on_their_surroundings_only():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    passage = " ".join(rng.choice(words) for _ in range(3000))
    one, two = bpe_chunks.chunks(passage, 8), bpe_chunks.chunks("elsewhere " * 7 + passage, 8)
    assert "".join(one) == passage and one[1:] == two[-len(one) + 1 :] and len(one) > 20
    long = "".join(rng.choice("abcd ") for _ in range(3 * bpe_chunks.BLOCK))
    assert bpe_chunks.chunks(long, 6)[-50:] == bpe_chunks.chunks(long[bpe_chunks.BLOCK + 7 :], 6)[-50:]
    flat = bpe_chunks.chunks("a" * (bpe_chunks.LONGEST * 2 + 5), 30)
    assert [len(c) for c in flat] == [bpe_chunks.LONGEST] * 2 + [5]
    assert bpe_chunks.chunks("", 8) == []


def test_shared_chunks_are_encoded_once(files, model, spark):
    rng = random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900))
    texts = [f"start{i} {passage} end{i}" for i in range(30)] + ["own text only", "", None, passage.replace(" ", "")]
    rows = files([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, ids string, row long")
    got = {r.doc_id: r for r in bpe_chunks.tokenize(rows, word_model(), bits=7).collect()}
    assert len(got) == len(texts) and all(got[i].ids == ids_of(model, t) and got[i].row == i for i, t in enumerate(texts))
    counts = {}
    for t in texts:
        for c in bpe_chunks.chunks(t or "", 7):
            counts[c] = counts.get(c, 0) + 1
    from millrace.llm.bits import bit_filter

    keys = spark.createDataFrame([(int(k),) for k in bpe_chunks.keys_of([c for c, n in counts.items() if n > 1]).view(np.int64)], "key long")
    known = spark.sparkContext.broadcast(bit_filter(keys, "key"))
    made = bpe_chunks.chunk_table(rows.selectExpr("coalesce(text, '') AS text"), known, word_model(), 7).collect()
    assert sorted(bytes(r.digest) for r in made) == sorted(bpe_chunks.digest(c) for c, n in counts.items() if n > 1)


def test_empty_table_and_repeated_rows(files, docs, model):
    assert bpe_chunks.digests(files([], "doc_id long, text string"), word_model()).count() == 0
    rows = docs([(None, "Hi there"), (4, "Hi there"), (4, "Hi there")])
    assert [r.n_tokens for r in bpe_chunks.digests(rows, word_model()).collect()] == [len(ids_of(model, "Hi there"))] * 3


def test_query_is_the_library(spark, sf_dir, model):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = QUERIES["op11_bpe_chunks"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ids_of(model, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids, skip_special_tokens=False)))
