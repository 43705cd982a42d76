import random
from collections import Counter

import re

from millrace.llm import phrases

SCHEMA = "doc_id long, text string, lang string, codes string, part int"


def brute(rows, least, top):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    out = {}
    cands = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    within = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    for (lang, p), a in cands.items():
        if any(l2 == lang and len(q) > len(p) and b >= a and within(p, q) for (l2, q), b in cands.items()):
            continue
        n = sizes[lang]
        score, k = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], n))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n, -s) for lang, found in out.items() for rank, (s, a, p, l, r, n) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(df):
    return sorted(tuple(r[c] for c in "lang rank phrase a l r n score".split()) for r in df.collect())


def test_against_brute_force_with_extended_prefixes(files):
    rng = random.Random(4)
    words = ["The", "of", "é", "a'b", "x\x01y", "sea", "SEA", "zz", "rare%d"]
    rows = []
    for i in range(200):
        text = "".join(rng.choice(words).replace("%d", str(rng.randint(0, 500))) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ", "]) for _ in range(rng.randint(0, 80)))
        rows.append((text if i % 9 else "the of The sea " * 10, rng.choice(["en", "en", None, "fr"])))
    rows += [(None, "en"), ("", None), (rows[1][0], rows[1][1])]
    df = files([(i, t, lang, "c", 1) for i, (t, lang) in enumerate(rows)], SCHEMA, parts=3)
    want = brute(rows, 8, 40)
    assert len(want) > 60 and max(len(w[2].split()) for w in want) == 5
    for budget in (phrases.BUDGET, 400, 40):
        assert rows_of(phrases.collocations(df, least=8, top=40, budget=budget)) == want


def test_empty_table(files):
    df = files([], SCHEMA)
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(files([(1, "", None, "", 0)], SCHEMA, "blank")).count() == 0


def test_numbers_beyond_64_bits(spark, monkeypatch):
    big = 10**12
    words = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 2, big), ("en", "z", 3, 8 * big)], "lang string, word string, code long, n long")
    found = spark.createDataFrame([("en", [1, 2], big - 1)], "lang string, codes array<long>, a long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (words, found))
    row = phrases.collocations(None).first()
    assert row.phrase == "a b" and row.score == 1000 * (big - 1) * 10 * big // (big * big)


def test_words_that_share_a_hash_are_seen(spark):
    schema, big = "lang string, word string, hash long, n long", phrases.SHORT + 5
    assert phrases.one_to_one(spark.createDataFrame([("en", "a", big, 1), ("fr", "a", big, 1), ("fr", "b", -6, 1)], schema))
    assert not phrases.one_to_one(spark.createDataFrame([("en", "a", big, 1), ("fr", "b", big, 1)], schema))
    assert not phrases.one_to_one(spark.createDataFrame([("en", "a", 0, 1)], schema))
    assert not phrases.one_to_one(spark.createDataFrame([("en", "a", 7, 1)], schema))


def test_few_short_codes_change_nothing(files, monkeypatch):
    rng = random.Random(8)
    rows = [(" ".join(rng.choice("abcdefg") for _ in range(60)), "en") for _ in range(40)]
    df = files([(i, t, lang, "", 0) for i, (t, lang) in enumerate(rows)], SCHEMA)
    monkeypatch.setattr(phrases, "SHORT", 3)
    assert rows_of(phrases.collocations(df, least=9, top=50)) == brute(rows, 9, 50)


def test_query_is_its_sql(spark):
    import duckdb

    from millrace.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({phrases.ORACLE})").fetchall())
    assert want and rows_of(QUERIES["op12_collocations"](spark, sf)) == want
