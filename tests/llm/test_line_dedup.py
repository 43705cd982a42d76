import random

from millrace.llm import line_dedup


def test_query(same_as_sql):
    same_as_sql("op9_line_dedup")


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def clean(files, rows):
    table = files(rows, "doc_id long, text string, h int, n int")
    return {r.doc_id: (r.text, r.lines_deleted) for r in line_dedup.drop_repeats(table).collect()}


def test_runs_of_fifty_words_go_and_short_ones_stay(files):
    rng = random.Random(1)
    run = [words(rng, n) for n in (12, 20, 3, 25)]
    one, short = words(rng, 56), words(rng, 30)
    own = [[words(rng, 15) for _ in range(6)] for _ in range(5)]
    texts = [
        [*own[0], *run, "", one, short],
        [own[1][0], *run, own[1][1], short],
        [own[2][0], "  " + one + " ", own[2][1]],
        [*run[1:3], own[3][0]],
        [*own[4], one, one],
    ]
    got = clean(files, [(i, "\n".join(t), 0, 0) for i, t in enumerate(texts)])
    assert got[0] == ("\n".join(texts[0]), 0)
    assert got[1] == ("\n".join([own[1][0], own[1][1], short]), 4)
    assert got[2] == ("\n".join([own[2][0], own[2][1]]), 1)
    assert got[3] == ("\n".join(texts[3]), 0)
    assert got[4] == ("\n".join(own[4]), 2)


def test_every_repeated_run_is_found(files):
    """Random cuts of shared text: wherever fifty words or more agree, the later document loses them."""
    rng = random.Random(2)
    source = [words(rng, rng.randint(1, 14)) for _ in range(120)]
    rows, planted = [(0, "\n".join(source), 0, 0)], {}
    for i in range(1, 40):
        a = rng.randrange(100)
        cut = source[a : a + rng.randint(1, 20)]
        before, after = [[words(rng, rng.randint(1, 9)) for _ in range(rng.randint(0, 4))] for _ in "ab"]
        rows.append((i, "\n".join([*before, *cut, *after]), 0, 0))
        planted[i] = (cut, before, after)
    got = clean(files, rows)
    assert got[0] == (rows[0][1], 0)
    for i, (cut, before, after) in planted.items():
        n = sum(len(x.split()) for x in cut)
        if n >= line_dedup.GUARANTEE:
            assert got[i] == ("\n".join([*before, *after]), len(cut))
        elif n < line_dedup.NOISE:
            assert got[i][1] == 0


def test_run_held_whole_by_a_second_document(files):
    """A holds a part of a run, B and C hold all of it: C loses what it shares with B, also ahead of and behind A's part."""
    rng = random.Random(7)
    rows, runs = [], []
    for t in range(40):
        run = [words(rng, 6) for _ in range(10)]
        a = rng.randrange(4)
        own = [[words(rng, rng.randint(3, 9)) for _ in range(2)] for _ in range(3)]
        for i, part in enumerate((run[a : a + 7], run, run)):
            rows.append((3 * t + i, "\n".join([own[i][0], *part, own[i][1]]), 0, 0))
        runs.append(own)
    got = clean(files, rows)
    for t, own in enumerate(runs):
        assert got[3 * t] == (rows[3 * t][1], 0)
        assert got[3 * t + 2] == ("\n".join(own[2]), 10)


def test_null_empty_repeats_and_order(files):
    rng = random.Random(3)
    text = "\n".join(words(rng, 30) for _ in range(4))
    long = "\n".join(words(rng, 5) for _ in range(3000))
    rows = [(None, text, 1, 2), (7, text, 1, 2), (3, text, 1, 2), (4, None, 1, 2), (5, "", 1, 2), (6, "\n\n", 1, 2), (8, long, 0, 0), (9, long + "\nend", 0, 0)]
    table = files(rows, "doc_id long, text string, h int, n int")
    got = {r.doc_id: (r.text, r.lines_deleted) for r in line_dedup.drop_repeats(table).collect()}
    assert got == {None: ("", 4), 7: ("", 4), 3: (text, 0), 4: (None, 0), 5: ("", 0), 6: ("\n\n", 0), 8: (long, 0), 9: ("end", 3000)}
    twice = line_dedup.drop_repeats(files([(1, text, 0, 0)] * 3, "doc_id long, text string, h int, n int", "twice")).collect()
    assert sorted(r.lines_deleted for r in twice) == [0, 4, 4]
    assert line_dedup.drop_repeats(files([], "doc_id long, text string", "none")).count() == 0


def test_no_python_in_the_plan(files):
    table = files([(1, "a")], "doc_id long, text string")
    plan = line_dedup.fingerprints(line_dedup.lines_of(table.selectExpr("doc_id as __row", "doc_id", "text")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
