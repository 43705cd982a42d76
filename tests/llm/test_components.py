import random

from millrace.llm.components import components


def test_components_against_union(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(7, 7), (5, 4), (5, 4)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: label[n] for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
