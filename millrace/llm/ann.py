"""Approximate nearest neighbours by cosine: a graph from NN-descent, searched greedily.

Equal vectors are one node, so copies do not crowd each other out of the graph; a node keeps the smallest
identifiers of its vectors, as many as a search can return.

Start: the nodes are sorted by the signs of random projections, several times over, and each is linked to
the nearest of its leaf, a short stretch of that order. Descent: the neighbours of neighbours are joined.
Every node gathers the nodes that it links to and those that link to it, compares them with each
other, and each takes links that beat its own. Only pairs with a link that is new are compared, and
the rounds end when few links are. A node to which very many link gathers them in blocks, so no link is
left out and no group is large.

Search: each query starts at the node of its own vector, or at fixed entry nodes if no row has it, and again
and again expands its nearest nodes that are not expanded yet, until its ``BEAM`` nearest are. Graphs are
built on components of one byte; the search scores in double precision on the original vectors.

Approximate: recall is measured against brute force in the tests. Defined cases: vectors that are null, of
another length than most, zero, or with null or non-finite components take no part, nor do null identifiers.
Repeated rows with one identifier and vector count once. Ties go to the smaller identifier.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.texts import stored

#: Links of a node, in-links in a block, share of new links to stop at.
LINKS, BLOCK, STILL = 24, 48, 0.05
#: Orders of the start, nodes of a leaf, links that a leaf gives a node.
ORDERS, LEAF, PICKED = 20, 2048, 12
#: Nodes that a search expands, and entry nodes for queries that are not in the index.
BEAM, ENTRIES = 40, 8
SEED = 11


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vector of doubles, norm) of the rows that take part, each pair of id and vector once."""
    vector = F.col(vec_col).cast("array<double>")
    sound = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).filter(
        "id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    ).withColumn("norm", F.sqrt(dot(F.col("vector"), F.col("vector")))).filter("norm > 0 and norm < double('infinity')")
    usual = sound.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return sound.filter(F.size("vector") == (usual.length if usual else 0))


def pack(vector: Column, dtype: str) -> Column:
    """A vector as bytes; as "int8" scaled so that its largest component is 127."""

    @F.arrow_udf("binary")
    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.binary())
        rows = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1) + 0.0
        if dtype == "int8":
            rows = np.rint(rows * (127 / np.abs(rows).max(axis=1, keepdims=True)))
        return pa.array([r.tobytes() for r in rows.astype(dtype)], pa.binary())

    return run(vector)


def nodes_of(df: DataFrame, keep: int) -> DataFrame:
    """(node, vector, norm, packed, ids): distinct vectors under their smallest id, with their ``keep`` smallest ids."""
    keyed = stored(df.withColumns({"key": F.sha2(pack(F.col("vector"), "<f8"), 256)}), "vectors")
    # The rank is bounded, so each task first drops what cannot be among the smallest of a key.
    smallest = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    ids = keyed.select("key", "id").distinct().withColumn("nth", smallest).filter(F.col("nth") <= keep)
    kept = ids.groupBy("key").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids"))
    first = keyed.dropDuplicates(["id", "key"]).join(kept, ["key", "id"])
    return stored(first.select(
        F.col("id").alias("node"), "vector", "norm", pack(F.col("vector"), "int8").alias("packed"), "ids", "key"
    ), "nodes")


def unpack(column) -> np.ndarray:
    """Rows of length one from packed vectors."""
    rows = np.frombuffer(b"".join(column.to_pylist()), dtype=np.int8).reshape(len(column), -1).astype(np.float32)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("near", pa.float32())])


def edge_batch(u, v, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(near, pa.float32())], schema=EDGES)


def signatures(length: int, orders: int, bits: int = 24):
    """Arrow function: for each packed vector its place in every order, as the signs of random projections."""

    @F.arrow_udf("array<long>")
    def run(packed: pa.Array) -> pa.Array:
        if not len(packed):
            return pa.array([], pa.list_(pa.int64()))
        planes = np.random.default_rng(SEED).standard_normal((length, orders * bits)).astype(np.float32)
        signs = (unpack(packed) @ planes > 0).reshape(len(packed), orders, bits)
        return pa.array((signs * (1 << np.arange(bits)[::-1])).sum(axis=2).tolist(), pa.list_(pa.int64()))

    return run


def leaf_links(links: int, leaf: int):
    """Links inside the leaves of sorted rows (order, node, packed)."""

    def compare(nodes: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        k, parts = min(links, len(nodes) - 1), []
        for at in range(0, len(nodes), 256):
            near = vectors[at : at + 256] @ vectors.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
            best = np.argpartition(near, len(nodes) - k, axis=1)[:, len(nodes) - k :]
            parts.append((best, np.take_along_axis(near, best, axis=1)))
        best, near = (np.concatenate(x) for x in zip(*parts))
        return edge_batch(np.repeat(nodes, k), nodes[best.ravel()], near.ravel())

    def run(batches):
        order, nodes, vectors = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            order = np.concatenate([order, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(1).to_numpy()])
            vectors = unpack(batch.column(2)) if vectors is None else np.concatenate([vectors, unpack(batch.column(2))])
            while len(order) and (stop := int(np.searchsorted(order, order[0], side="right"))) and (stop < len(order) or stop >= 2 * leaf):
                cut = leaf if stop >= 2 * leaf else stop
                if cut > 1:
                    yield compare(nodes[:cut], vectors[:cut])
                order, nodes, vectors = order[cut:], nodes[cut:], vectors[cut:]
        if len(order) > 1:
            yield compare(nodes, vectors)

    return run


def nearest_links(edges: DataFrame, links: int) -> DataFrame:
    """The ``links`` nearest of each node from rows (u, v, near, fresh); a link met before is not fresh."""
    once = edges.groupBy("u", "v").agg(F.max("near").alias("near"), F.min("fresh").alias("fresh"))
    nth = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("near"), "v"))
    return once.withColumn("nth", nth).filter(F.col("nth") <= links).drop("nth")


def first_graph(nodes: DataFrame, links: int) -> DataFrame:
    row = nodes.select(F.octet_length("packed").alias("length")).first()
    if row is None:
        return stored(nodes.select(F.col("node").alias("u"), F.col("node").alias("v"), F.lit(0.0).cast("float").alias("near"), F.lit(True).alias("fresh")), "graph")
    places = nodes.select("node", "packed", F.posexplode(signatures(row.length, ORDERS)(F.col("packed"))).alias("order", "place"))
    parts = nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = places.repartitionByRange(int(parts), "order", "place", "node").sortWithinPartitions("order", "place", "node")
    found = dealt.select(F.col("order").cast("long"), "node", "packed").mapInArrow(leaf_links(min(links, PICKED), LEAF), "u long, v long, near float")
    return stored(nearest_links(found.withColumn("fresh", F.lit(True)), links), "graph")


def compare_blocks(batches):
    """Links that beat those of their node, from rows sorted by (w, block): (w, block, member, fresh, worst, packed)."""
    held = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)] + [unpack(batch.column(5))]
        held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
        bounds = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
        if len(bounds):
            yield from _blocks([x[: bounds[-1]] for x in held], bounds[:-1])
            held = [x[bounds[-1] :] for x in held]
    if held is not None and len(held[0]):
        yield from _blocks(held, np.zeros(0, np.int64))


def _blocks(rows, bounds):
    _, _, member, fresh, worst, vectors = rows
    us, vs, nears = [], [], []
    edges = [0, *bounds.tolist(), len(member)]
    for a, b in zip(edges, edges[1:]):
        new = fresh[a:b].astype(bool)
        if not new.any():
            continue
        m, x = member[a:b], vectors[a:b]
        near = x @ x.T
        better = (near > worst[a:b, None]) & (new[:, None] | new[None, :]) & (m[:, None] != m[None, :])
        i, j = np.nonzero(better)
        us.append(m[i])
        vs.append(m[j])
        nears.append(near[i, j])
    if us:
        yield edge_batch(np.concatenate(us), np.concatenate(vs), np.concatenate(nears))


def descend(nodes: DataFrame, graph: DataFrame, links: int) -> DataFrame:
    """One round: neighbours of neighbours by way of every node that links them."""
    degree = graph.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    inward = graph.join(degree, "v").select(
        F.col("v").alias("w"), F.pmod(F.xxhash64("u", "v"), F.col("blocks")).cast("long").alias("block"), F.col("u").alias("member"), "fresh"
    )
    outward = graph.join(degree.withColumnRenamed("v", "u"), "u", "left").select(
        F.col("u").alias("w"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)).cast("long") - 1)).alias("block"),
        F.col("v").alias("member"), "fresh",
    )
    around = inward.unionByName(outward).groupBy("w", "block", "member").agg(F.max("fresh").alias("fresh"))
    worst = graph.groupBy("u").agg(F.min("near").alias("worst"), F.count(F.lit(1)).alias("n"))
    known = nodes.select("node", "packed").join(worst, nodes["node"] == worst["u"], "left").select(
        F.col("node").alias("member"), F.when(F.col("n") >= links, F.col("worst")).otherwise(-2.0).cast("float").alias("worst"), "packed"
    )
    gathered = around.join(known, "member").select("w", "block", "member", "fresh", "worst", "packed")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = gathered.repartition(parts, "w", "block").sortWithinPartitions("w", "block").mapInArrow(
        compare_blocks, "u long, v long, near float"
    )
    both = graph.withColumn("fresh", F.lit(False)).unionByName(met.withColumn("fresh", F.lit(True)))
    return stored(nearest_links(both, links), "graph")


def build(nodes: DataFrame, links: int = LINKS) -> DataFrame:
    """The neighbour graph (u, v, near, fresh). Links only give way to nearer ones, so the rounds end."""
    graph = first_graph(nodes, links)
    while True:
        graph = descend(nodes, graph, links)
        fresh, every = graph.agg(F.count_if("fresh"), F.count(F.lit(1))).first()
        if fresh <= STILL * every:
            break
    return graph


def both_ways(graph: DataFrame, links: int) -> DataFrame:
    """(u, v): the nodes that a node links to, and as many of the nearest that link to it."""
    back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "near", F.lit(False).alias("fresh"))
    return graph.select("u", "v").unionByName(nearest_links(back, links).select("u", "v")).distinct()


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(query_id, vec_id, score, rank): for rows (query_id, vector, norm, key), the k nearest other ids found."""
    ways = stored(both_ways(graph, LINKS), "ways")
    known = nodes.select("node", F.col("vector").alias("v"), F.col("norm").alias("v_norm"))
    asked = queries.select("query_id", F.col("vector").alias("q"), F.col("norm").alias("q_norm"))

    def scored(pairs: DataFrame) -> DataFrame:
        full = pairs.join(known, "node").join(asked, "query_id")
        return full.select("query_id", "node", (dot(F.col("q"), F.col("v")) / (F.col("q_norm") * F.col("v_norm"))).alias("score"))

    at_home = queries.join(nodes.select("key", "node"), "key", "left")
    entries = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node")).limit(ENTRIES).collect()]
    home = at_home.filter("node is not null").select("query_id", "node")
    away = at_home.filter("node is null").select("query_id", F.explode(F.array(*map(F.lit, entries)) if entries else F.array().cast("array<long>")).alias("node"))
    pool = stored(scored(home.unionByName(away)).withColumn("open", F.lit(True)), "pool")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    while True:
        ranked = pool.withColumn("nth", F.row_number().over(nearest))
        front = ranked.filter((F.col("nth") <= beam) & F.col("open"))
        reached = front.select("query_id", F.col("node").alias("u")).join(ways, "u").select("query_id", F.col("v").alias("node")).distinct()
        new = reached.join(pool.select("query_id", "node"), ["query_id", "node"], "left_anti")
        grown = ranked.withColumn("open", F.col("open") & (F.col("nth") > beam)).drop("nth").unionByName(scored(new).withColumn("open", F.lit(True)))
        pool = stored(grown, "pool")
        left = pool.withColumn("nth", F.row_number().over(nearest)).filter((F.col("nth") <= beam) & F.col("open"))
        if left.isEmpty():
            break
    ids = pool.join(nodes.select("node", F.explode("ids").alias("vec_id")), "node").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(df: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """For each row whose identifier is divisible by ``every``: its k nearest other rows."""
    sound = usable(df, id_col, vec_col)
    nodes = nodes_of(sound, k + 1)
    graph = build(nodes)
    asked = sound.filter(F.pmod("id", F.lit(every)) == 0).dropDuplicates(["id"])
    queries = stored(asked.select(
        F.col("id").alias("query_id"), "vector", "norm", F.sha2(pack(F.col("vector"), "<f8"), 256).alias("key")
    ), "queries")
    return search(queries, nodes, graph, k)
