import random

import numpy as np
import pytest

from millrace.llm import token_counts
from millrace.llm.queries import rank_file
from millrace.llm.token_counts import attribute


def plain(lengths, starts, stops, rule):
    """Byte by byte: the section of each token."""
    owner, at = [], 0
    of = {b: i for i, (s, e) in enumerate(zip(starts, stops)) for b in range(s, e)}
    for n in lengths:
        held = [of.get(b, -1) for b in range(at, at + n)]
        counts = {s: held.count(s) for s in held if s >= 0}
        if rule == "first":
            owner.append(held[0])
        else:
            owner.append(min(counts, key=lambda s: (-counts[s], s)) if counts else -1)
        at += n
    return owner


@pytest.mark.parametrize("rule", ["largest", "first"])
def test_interval_join_against_bytes(rule):
    rng = random.Random(1)
    for _ in range(300):
        lengths = [rng.randint(1, 7) for _ in range(rng.randint(0, 20))]
        cuts = sorted(rng.sample(range(sum(lengths) + 1), min(rng.randint(0, 8) * 2, (sum(lengths) + 1) // 2 * 2)))
        starts, stops = cuts[::2], cuts[1::2]
        owner, _ = attribute(np.array(lengths, dtype=np.int64), np.array(starts, dtype=np.int64), np.array(stops, dtype=np.int64), rule)
        assert owner.tolist() == plain(lengths, starts, stops, rule)


def test_query_counts_every_token_once(spark, sf_dir):
    from millrace.llm.queries import QUERIES
    from millrace.llm.texts import table

    encoding, _ = token_counts.ranked(*rank_file())
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = {}
    for r in QUERIES["op7_token_counts"](spark, sf_dir).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert rows.keys() == texts.keys()
    for doc_id, sections in rows.items():
        text, ids = texts[doc_id], encoding.encode_ordinary(texts[doc_id])
        sections.sort(key=lambda r: r.section)
        assert all("\n" not in text[r.start : r.stop - 1] for r in sections)
        assert "".join(text[r.start : r.stop] for r in sections) == text
        assert sum(r.n_tokens for r in sections) == len(ids) == sections[0].doc_tokens
        lengths = [len(encoding.decode_single_token_bytes(i)) for i in ids]
        bounds = [len(text[: r.start].encode()) for r in sections] + [len(text.encode())]
        assert [r.n_tokens for r in sections] == [plain(lengths, bounds[:-1], bounds[1:], "largest").count(i) for i in range(len(sections))]


def test_fields_of_a_row(files):
    rows = files([(1, "title é", None, "body text", 3), (2, None, None, None, 4), (2, None, None, None, 4)],
                 "doc_id long, a string, b string, c string, n_tokens int")
    got = token_counts.count_fields(rows, ["a", "b", "c"], *rank_file()).collect()
    first = next(r for r in got if r.doc_id == 1)
    encoding, _ = token_counts.ranked(*rank_file())
    assert first.n_tokens == len(encoding.encode_ordinary("title é\n\nbody text"))
    assert sum(s.n_tokens for s in first.section_tokens) == first.n_tokens
    assert {s.section for s in first.section_tokens} <= {-1, 0, 1, 2}
    assert len(got) == 3


def test_crossing_token_goes_to_one_section(files):
    rows = files([("hello world", [(0, 3), (3, 7), (8, 11)]), (None, None)], "text string, parts array<struct<start: int, stop: int>>")
    for rule, want in (("largest", [1, 0, 1]), ("first", [1, 1, 0])):
        got = token_counts.count_sections(rows, *rank_file(), sections="parts", rule=rule).filter("text is not null").first()
        assert [s.n_tokens for s in got.section_tokens] == want and sum(s.n_crossing for s in got.section_tokens) == 2
    with pytest.raises(ValueError):
        token_counts.count_sections(rows, *rank_file(), rule="other")


def test_null_empty_and_long(docs):
    got = token_counts.section_rows(docs([(1, None), (None, ""), (2, "a\n" * 3), (2, "a\n" * 3), (3, "word " * 40_000)]), *rank_file())
    rows = sorted((str(r.doc_id), r.section, r.n_tokens) for r in got.collect())
    assert rows[:2] == [("1", 0, 0), ("2", 0, 2)] and rows[-1] == ("None", 0, 0) and len(rows) == 9
    none = got.sparkSession.createDataFrame([], "doc_id long, text string")
    assert token_counts.section_rows(none, *rank_file()).count() == 0
