import random
import re

import pytest
import xxhash

from millrace.llm import simhash

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_print(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints, distance=2):
    """Smallest reachable identifier by brute force."""
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_query_against_brute_force(spark, sf_dir):
    from millrace.llm.queries import QUERIES
    from millrace.llm.texts import table

    prints = [(r.doc_id, plain_print(r.text)) for r in table(spark, sf_dir, "documents").collect()]
    label = classes(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{p:016x}", label[i]) for i, p in prints}


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_keep_all_components(spark, bucket):
    """Crowded buckets, linked through points, give the same components as pairs."""
    rng, prints = random.Random(8), []
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(25)]
    nodes = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in nodes]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), bucket).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links)
    want = classes(list(zip(range(len(nodes)), nodes)))
    at, parent = {p: i for i, p in enumerate(signed)}, list(range(len(nodes)))
    for _ in range(len(nodes)):
        for r in links:
            low = min(parent[at[r.a]], parent[at[r.b]])
            parent[at[r.a]] = parent[at[r.b]] = low
    assert parent == [want[i] for i in range(len(nodes))]


def test_chain_budgets_prune_no_link(spark):
    from pyspark.sql import functions as F

    rng, rows = random.Random(9), []
    for _ in range(400):
        a = rng.getrandbits(63)
        rows.append((a, a ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 20)))))
    for distance, segments in ((2, 3), (16, 8)):
        masks = simhash.ring_masks(segments)
        held = F.lit(False)
        for start in range(segments):
            held = held | simhash.in_budget(F.col("a"), F.col("b"), start, masks, distance)
        far = spark.createDataFrame(rows, "a long, b long").filter(~held).collect()
        assert far and all((r.a ^ r.b).bit_count() > distance for r in far)


def test_null_empty_and_repeats(docs):
    rows = [(4, None), (2, ""), (3, " \t "), (None, "A b C d"), (9, "a B c d"), (None, "only here now"), (9, "a B c d"), (5, "one"), (6, "x " * 60_000)]
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.similar_documents(docs(rows)).collect())
    want = [("4", 2), ("2", 2), ("3", 2), ("None", 9), ("9", 9), ("None", None), ("9", 9), ("5", 5), ("6", 6)]
    prints = [f"{plain_print(t):016x}" for _, t in rows]
    assert got == sorted(((i, p, c) for (i, c), p in zip(want, prints)), key=lambda x: (x[0], x[1]))


def test_empty(files):
    assert simhash.similar_documents(files([], "doc_id long, text string")).count() == 0


def test_near_copies_go(files):
    rng, rows = random.Random(10), []
    for g in range(12):
        base = [f"g{g}w{rng.randint(0, 500)}" for _ in range(200)]
        for i in range(6):
            text = list(base)
            text[10 + 25 * i % 190] = "changed"  # five of 196 shingles on either side
            rows.append((g * 10 + i, " ".join(text), "x"))
    rows += [(900, "", "x"), (901, None, "x"), (902, "short one", "x"), (None, "short one", "x"), (903, "short two", "x"), (903, "short two", "x")]
    got = simhash.drop_near_duplicates(files(rows, "doc_id long, text string, fp string")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted([*(str(g * 10) for g in range(12)), "900", "902", "903"])
    assert got[0].asDict().keys() == {"doc_id", "text", "fp"}


def changed(rng, words, n, mark):
    out = list(words)
    for at in rng.sample(range(len(words)), n):
        out[at] = f"{mark}{at}"
    return out


def kept_by_brute_force(texts, words=5, similarity=0.8):
    """Smallest identifiers of the groups that exact resemblance joins."""
    sets = []
    for t in texts:
        found = t.split()
        sets.append({tuple(found[i : i + words]) for i in range(len(found) - words + 1)})
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (common := len(sets[i] & sets[j])) / (len(sets[i]) + len(sets[j]) - common) >= similarity and top(i) != top(j):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [i for i in range(len(texts)) if root[i] == i]


def test_star_of_copies_is_one_group(files):
    """Copies resemble their original, but hardly each other, and the original is no leader of theirs."""
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(400)]
    texts = [" ".join(base)] + [" ".join(changed(rng, base, 8, f"c{i}x")) for i in range(1500)]
    got = simhash.drop_near_duplicates(files([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    exact = kept_by_brute_force(texts[:300])
    assert len(exact) < 60 and sorted(r.doc_id for r in got if r.doc_id < 300) == exact and len(got) < 300


def test_blocks_join_what_is_similar(spark):
    rng, sets = random.Random(13), {}
    for n in range(120):
        base = range(1000 * (n % 9), 1000 * (n % 9) + 40)
        sets[n] = sorted({x if rng.random() < 0.95 else rng.randint(10**6, 10**7) for x in base})
    rows = [(n % 9 // 3, n, n if n % 5 else n % 9, x) for n, x in sets.items()]
    members = spark.createDataFrame(rows, "cluster long, node long, root long, found array<long>")
    for together in (7, 512):
        links = [(r.a, r.b) for r in simhash.block_links(members, 0.8, together=together).collect()]
        like = lambda a, b: len({*sets[a]} & {*sets[b]}) / len({*sets[a]} | {*sets[b]}) >= 0.8
        assert all(like(a, b) for a, b in links)
        start = {n: r for _, n, r, _ in rows}
        wanted = [(a, b) for a in sets for b in range(a) if a % 9 // 3 == b % 9 // 3 and like(a, b) and start[a] != start[b]]
        assert wanted and not simhash.spanning(wanted, joined(start, links)) and not simhash.spanning(links, joined(start, wanted))


def joined(roots, links):
    """The roots after the links."""
    out = dict(roots)
    for a, b in links:
        old, new = out[a], out[b]
        out = {n: new if r == old else r for n, r in out.items()}
    return out


def test_a_common_passage_gathers_nobody(files):
    rng = random.Random(14)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80)) + " " + passage for _ in range(200)]
    nodes = files([(i, t) for i, t in enumerate(texts)], "node long, text string")
    sketched = nodes.select("node", simhash.sketched(nodes["text"], 5).alias("x")).select("node", "x.*")
    assert simhash.rare_anchors(sketched).count() == 0


def test_pairs_near_the_limit_are_settled_on_whole_texts(files):
    """Sketches of 128 put about a quarter of such pairs on the wrong side."""
    rng, texts = random.Random(12), []
    for g in range(60):
        base = [f"g{g}w{rng.randint(0, 5000)}" for _ in range(600)]
        texts += [" ".join(base), " ".join(changed(rng, base, rng.choice([10, 12, 14, 16]), "x"))]
    got = simhash.drop_near_duplicates(files([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    exact = kept_by_brute_force(texts)
    assert sorted(r.doc_id for r in got) == exact and 60 < len(exact) < 120
