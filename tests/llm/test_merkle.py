import hashlib
import random
import zlib

import pytest

from millrace.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, tree int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h("".join(parts))


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row, level by level."""

    def climb(nodes):
        paths = [[] for _ in nodes]
        groups = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            for i, members in enumerate(groups):
                other = i ^ 1
                for m in members:
                    paths[m].append(None if other >= len(nodes) else (other < i, nodes[other]))
            nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            groups = [sum(groups[i : i + 2], []) for i in range(0, len(groups), 2)]
        return nodes[0], paths

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        some = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((some, *climb([leaf(*r) for r in some])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (some, subroot, paths), up in zip(trees, above):
        for r, path in zip(some, paths):
            path = path + up
            tampered = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(*r[:4], r[4] + 1) if tampered else leaf(*r)
            for step in path:
                now = h(now) if step is None else h(step[1], now) if step[0] else h(now, step[1])
            out.append((str(r[0]), leaf(*r), subroot, root, h(*[s[1] for s in path if s]), now, now == root))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("sizes", [[1], [1, 1], [5, 1, 16], [33, 2, 7, 1]])
def test_against_brute_force(files, sizes, monkeypatch):
    rng = random.Random(sum(sizes))
    langs = [None, "en", "é", "", "zz"][: len(sizes)]
    rows = [(rng.randint(0, 300), rng.choice(["ab", "", None, "ü"]), lang, rng.choice([None, "s"]), rng.choice([None, 3, 2**63 - 1])) for lang, n in zip(langs, sizes) for _ in range(n)]
    rows += [rows[0], (None, None, None, None, None)]
    rng.shuffle(rows)
    df = files([(*r, "p", 1) for r in rows], SCHEMA, parts=3)
    monkeypatch.setattr(merkle.manifest, "__defaults__", (None, 2))
    got = rows_of(merkle.tampering(df))
    assert got == brute(rows)


def test_empty_table(files):
    assert merkle.tampering(files([], SCHEMA)).count() == 0


def test_a_block_is_one_task_and_no_more(files):
    df = files([(i, "t", "en", "s", 1, "", 0) for i in range(70)], SCHEMA)
    assert rows_of(merkle.manifest(df, steps=3)) == rows_of(merkle.manifest(df, steps=12))


def test_query_is_its_sql(same_as_sql):
    same_as_sql("op13_merkle")
