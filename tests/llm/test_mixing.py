import hashlib
import itertools

import pytest

from millrace.llm import mixing
from millrace.llm.mixing import Level

LEVELS = [
    Level("lang", "coalesce(lang, 'unknown')", "case lang when 'a' then 3 when 'z' then 0 else 1 end"),
    Level("source", "coalesce(source, 'unknown')", "1"),
]


def test_query(same_as_sql):
    same_as_sql("op5_mixing")


def budgets(spark, leaves, parts, of, epochs):
    df = spark.createDataFrame(leaves, "lang string, source string, tokens long")
    return {(r.lang, r.source): r.budget for r in mixing.leaf_budgets(df, LEVELS, parts, of, epochs).collect()}


def test_weights_hold_where_there_is_enough(spark):
    got = budgets(spark, [("a", "s", 3000), ("b", "s", 1000), ("b", "t", 2000)], 1, 2, 1)
    assert got == {("a", "s"): 2250, ("b", "s"): 375, ("b", "t"): 375}


def test_shortage_goes_to_siblings_then_up(spark):
    # b may have 600: its child s has 100, so t takes 500. a is short by 700, and b takes that too.
    got = budgets(spark, [("a", "s", 1100), ("b", "s", 100), ("b", "t", 1200)], 1, 1, 1)
    assert got == {("a", "s"): 1100, ("b", "s"): 100, ("b", "t"): 1200}
    got = budgets(spark, [("a", "s", 600), ("b", "s", 100), ("b", "t", 1300)], 1, 2, 1)
    assert got == {("a", "s"): 600, ("b", "s"): 100, ("b", "t"): 300}


def test_budgets_add_up_and_weightless_leaves_get_nothing(spark):
    leaves = [(x, s, 17 * (i + 3)) for i, (x, s) in enumerate(itertools.product("abcz", "stuv"))]
    got = budgets(spark, leaves, 2, 3, 2)
    tokens = {(x, s): n for x, s, n in leaves if x != "z"}
    assert got.keys() == tokens.keys() and sum(got.values()) == sum(tokens.values()) * 2 // 3
    assert all(0 <= b <= 2 * tokens[leaf] for leaf, b in got.items())


@pytest.mark.parametrize("digits", [3, 1])
def test_prefix_against_brute_force(files, monkeypatch, digits):
    monkeypatch.setattr(mixing, "DIGITS", digits)
    rows = [(i, " ".join(["w"] * (i % 7)), "ab"[i % 2], None if i % 5 == 0 else f"s{i % 3}", 0) for i in range(300)]
    rows += [(300, None, None, "s1", 0), (1, "w w w w", "b", "s1", 9), (None, "x y z", "a", "s1", 0)]
    table = files(rows, "doc_id long, text string, lang string, source string, epoch int")
    got = mixing.mix(table, LEVELS, parts=3, of=2, max_epochs=2).collect()
    cuts = {(r.lang, r.source): r.budget for r in mixing.cuts(table, LEVELS, 3, 2, 2, 7).collect()}
    by_leaf = {}
    for i, text, lang, source, _ in rows:
        by_leaf.setdefault((lang or "unknown", source or "unknown"), []).append((i, len((text or "").split())))
    for leaf, budget in cuts.items():
        members = [m for m in by_leaf[leaf] if m[0] is not None]
        if len(members) < len(by_leaf[leaf]):
            continue  # the order of a row without identifier is its text's hash
        total = sum(n for _, n in members)
        want = []
        for epoch in range(budget // total + 1):
            rest, sums = budget - epoch * total, 0  # a whole epoch takes all rows, also those without tokens
            places = sorted((hashlib.md5(f"7:{epoch}:{i}".encode()).hexdigest(), i, n) for i, n in members)
            for place, group in itertools.groupby(places, key=lambda p: p[0]):
                group = list(group)
                if rest >= total or sums < rest:
                    want += [(i, epoch, place) for _, i, _ in group]
                sums += sum(n for _, _, n in group)
        mine = [(r.doc_id, r.epoch, r.place) for r in got if (r.lang or "unknown", r.source or "unknown") == leaf]
        assert sorted(mine) == sorted(want)


def test_empty_table(files):
    table = files([], "doc_id long, text string, lang string, source string")
    assert mixing.mix(table, LEVELS).count() == 0 and mixing.mixture(table).count() == 0


def test_no_python_in_the_plan(files):
    table = files([(1, "a", "a", "s1")], "doc_id long, text string, lang string, source string")
    plan = mixing.mixture(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
