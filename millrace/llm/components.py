"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.texts import stored


def _stars(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Edges (node, other) with the smallest neighbour of each node, or the node itself, as ``least``."""
    least = edges.groupBy(node).agg(F.least(F.min(other), F.col(node)).alias("least"))
    return edges.join(least, node)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node of its component.

    Large stars and small stars alternate (Kiveris et al. 2014): every node is hung on smaller ones until
    the edges no longer change. The edges of each round are a stored table, so no round recomputes
    another. A node with very many edges is a skewed join key, which adaptive execution splits; its
    minimum is combined before the shuffle.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now, state = stored(pair, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _stars(large, "u", "v")
        hung = small.select("u", F.col("least").alias("v")).unionByName(
            small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        ).distinct()
        now = stored(hung, "edges")
        sums = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if sums == state:
            break
        state = sums
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
