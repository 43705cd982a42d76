"""SimHash near-duplicates with pigeonring filtering.

Fingerprint: ASCII letters are lower-cased, words are runs of anything but ASCII white space, and each
shingle of ``words`` words counts with its repeats. A bit is 1 if it is set in over half of the XXH64
hashes (seed 42) of the shingles. Fewer words are one shingle; no words give fingerprint zero.

Links: two fingerprints link if at most ``DISTANCE`` of their 64 bits differ. The bits are cut into a ring
of ``DISTANCE + 1`` segments. Of two that link, some segment starts a chain in which the first l segments differ
in at most l * DISTANCE / segments bits together, for every l (the pigeonring principle). The first budget
is below one, so candidates agree in that segment and are found by an equality join on it; the other
budgets prune them before the full check. A bucket of more than ``BUCKET`` distinct fingerprints is not
paired: its members are linked through the points at distance one around them, which two fingerprints share
exactly if they differ in at most two bits. A point has at most 65 members, so no group is large.

Defined cases: null texts are empty. Equal fingerprints are one node however many rows have them. Null
identifiers take part but name no component; a component without identifiers has the null one. Repeated rows keep
their rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import components
from millrace.llm.texts import free_name, numbered, stored, whole

SEED, BITS, DISTANCE = 42, 64, 2
#: Distinct fingerprints up to which those of a bucket are paired.
BUCKET = 64
#: Shingles that are hashed and counted at a time.
BLOCK = 1 << 16


def shingle_hashes(text: str, words: int):
    """Blocks of the hashes of the shingles, in order."""
    import xxhash

    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) >= words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        yield np.array([digest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fold(blocks) -> int:
    """The fingerprint of the hashes, as a signed 64-bit number."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in blocks:
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int) -> Column:
    """The fingerprint of a text as a long."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fold(shingle_hashes(t, words)) for t in texts.to_pylist()], pa.int64())

    return run(text)


def hex_digits(value: str) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def ring_masks(segments: int) -> list[int]:
    """Bit masks of the segments, as signed numbers; the first ones are a bit wider if 64 is no multiple."""
    bounds = [round(BITS * i / segments) for i in range(segments + 1)]
    return [int(np.array((1 << b) - (1 << a), dtype=np.uint64).astype(np.int64)) for a, b in zip(bounds, bounds[1:])]


def differing(a: Column, b: Column, mask: int = -1) -> Column:
    return F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(mask)))


def in_budget(a: Column, b: Column, start: int, masks: list[int], distance: int) -> Column:
    """Whether the chain from segment ``start`` keeps to each of its proportional budgets."""
    m, ring, held = len(masks), 0, F.lit(True)
    for length in range(1, m + 1):
        ring |= masks[(start + length - 1) % m]
        held = held & (differing(a, b, ring) <= length * distance // m)
    return held


def near_links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints ``fp`` which differ in at most ``DISTANCE`` bits.

    All such pairs are joined by paths of links; pairs in large buckets need not be listed one by one.
    """
    masks = ring_masks(DISTANCE + 1)
    keys = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("start", "part"))
    shared = keys.groupBy("start", "part").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(keys.join(shared, ["start", "part"]), "segments")

    a, b = (members.filter(F.col("size") <= bucket).select("start", "part", F.col("fp").alias(n)) for n in "ab")
    chain = F.lit(False)
    for start in range(len(masks)):
        chain = chain | ((F.col("start") == start) & in_budget(F.col("a"), F.col("b"), start, masks, DISTANCE))
    paired = a.join(b, ["start", "part"]).filter((F.col("a") < F.col("b")) & chain)
    paired = paired.filter(differing(F.col("a"), F.col("b")) <= DISTANCE).select("a", "b")

    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(BITS)])
    crowded = members.filter(F.col("size") > bucket).select("fp").distinct()
    around = crowded.select("fp", F.explode(flips).alias("flip"))
    points = around.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("point")).agg(F.collect_list("fp").alias("fps"))
    met = points.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return paired.unionByName(met).distinct()


def groups(prints: DataFrame) -> DataFrame:
    """(fp, component_id) from rows (doc_id, fp): the smallest identifier reachable over links."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = components(near_links(nodes.select("fp")), "a", "b").withColumnRenamed("node", "fp")
    placed = nodes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(named, "root").select("fp", "component_id")


def similar_documents(df: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    prints = stored(df.select("doc_id", fingerprint(whole(df["text"]), words).alias("fp")), "prints")
    return prints.join(groups(prints), "fp").select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


# Near-duplicates at a stated similarity. Two texts of which 0.8 of the shingles agree differ in about ten of
# 64 bits: more than segments of useful width can hold equal. Candidates are therefore texts that share a rare one of
# their least shingle hashes; sizes, pigeonring budgets for WIDE bits over a ring of RING segments (five
# deviations above those ten bits) and sketches prune those that meet a leader, and whole sets of shingles decide.
WIDE, RING = 24, 8
#: Least distinct hashes kept of a text; of the first ANCHORS similar texts share at least the part COMMON (five
#: deviations below what 0.8 leads one to expect), so they share one of the rarest that are left beside so many.
SKETCH, ANCHORS, COMMON = 128, 32, 0.56
#: How far below the similarity sketches may put a pair (over four deviations).
MARGIN = 0.25
#: Texts, and shingles of texts, that a block holds; columns of a matrix of texts by shingles.
TOGETHER, SHINGLES, COLUMNS = 512, 1 << 18, 1 << 12
SKETCHED = "struct<fp: long, sketch: array<long>, size: long, same: binary>"


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct hashes of the shingles, in order as signed numbers."""
    blocks = list(shingle_hashes(text, words))
    return np.unique(np.concatenate(blocks).view(np.int64)) if blocks else np.zeros(0, dtype=np.int64)


def sketched(text: Column, words: int) -> Column:
    """Fingerprint of the distinct shingles, their least hashes, their number, and a key that equal sets share."""

    @F.arrow_udf(SKETCHED)
    def run(texts: pa.Array) -> pa.Array:
        from hashlib import blake2b

        prints, sketches, sizes, keys = [], [], [], []
        for text in texts.to_pylist():
            found = shingle_set(text, words)
            prints.append(fold(found[at : at + BLOCK].view(np.uint64) for at in range(0, len(found), BLOCK)))
            sketches.append(found[:SKETCH].copy())
            sizes.append(len(found))
            keys.append(blake2b(found.tobytes(), digest_size=16).digest())
        return pa.StructArray.from_arrays(
            [pa.array(prints, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())],
            ["fp", "sketch", "size", "same"],
        )

    return run(text)


def shingle_sets(text: Column, words: int) -> Column:
    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, words) for t in texts.to_pylist()], pa.list_(pa.int64()))

    return run(text)


def likely(similarity: float) -> Column:
    """Whether sizes and fingerprints (na, fa) and (nb, fb) allow the similarity."""
    masks, a, b = ring_masks(RING), F.col("fa"), F.col("fb")
    chain = F.lit(False)
    for start in range(RING):
        chain = chain | in_budget(a, b, start, masks, WIDE)
    sizes = F.least("na", "nb") >= F.lit(similarity) * F.greatest("na", "nb") - 1e-9
    return sizes & (differing(a, b) <= WIDE) & chain


def settled(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets of shingles resemble each other.

    The sketches only leave out what is far below; the texts (node, text) of the other pairs give their
    sets of shingles once more, and the common ones are counted.
    """
    sketches = nodes.select("node", "sketch", "size")
    both = pairs.join(sketches.toDF("a", "sa", "na"), "a").join(sketches.toDF("b", "sb", "nb"), "b")
    # Texts that resemble each other by s have s / (1 + s) of both sizes in common, the sketches in proportion.
    low = similarity - MARGIN
    expected = low / (1 + low) * (F.col("na") + F.col("nb")) * F.least(F.lit(1.0), SKETCH / F.greatest("na", "nb"))
    close = stored(both.filter(F.size(F.array_intersect("sa", "sb")) >= expected).select("a", "b"), "close")
    needed = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stored(texts.join(needed, "node").select("node", shingle_sets(whole("text"), words).alias("found")), "shingles")
    full = close.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    counted = full.select("a", "b", (F.size("sa") + F.size("sb")).alias("n"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return stored(counted.filter(F.col("common") / (F.col("n") - F.col("common")) >= similarity).select("a", "b"), "links")


def rare_anchors(nodes: DataFrame) -> DataFrame:
    """(node, anchor, weight): the hashes through which each row (node, sketch) meets others.

    Of two sets that have at least c of m elements in common, the m - c + 1 rarest of either, in one order of all,
    include a common one. Rarity is the number of texts with that hash among their least; one that no other
    text has gathers nobody. A passage of very many texts comes last in the order, so it gathers only texts
    that consist of it for the most part. ``weight`` is how common the hashes of the text are on average.
    """
    each = nodes.select("node", F.explode(F.slice("sketch", 1, ANCHORS)).alias("anchor"))
    counts = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    met = each.join(counts, "anchor").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("times", "anchor"))).alias("found"))
    size = F.least(F.size("sketch"), F.lit(ANCHORS))
    kept = met.join(nodes.select("node", "sketch"), "node").withColumn("size", size).withColumn(
        "open", F.size("found") - F.ceil(F.lit(COMMON) * F.col("size")).cast("int") + 1
    ).filter("open > 0")
    weight = F.aggregate("found", F.lit(0).cast("long"), lambda total, x: total + x["times"]) / F.col("size")
    return kept.select("node", weight.alias("weight"), F.explode(F.slice("found.anchor", F.lit(1), F.col("open"))).alias("anchor"))


def leader_pairs(members: DataFrame) -> DataFrame:
    """Pairs of each row (anchor, weight, node, fp, size) with the heaviest of its anchor: the centre of a group of copies."""
    leader = F.max_by(F.struct("node", "fp", "size"), F.struct("weight", "node"))
    shared = members.groupBy("anchor").agg(leader.alias("l"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    met = members.join(shared, "anchor").filter("node <> l.node")
    return met.select(
        F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b"),
        F.col("fp").alias("fa"), F.col("l.fp").alias("fb"), F.col("size").alias("na"), F.col("l.size").alias("nb"),
    )


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements every set of one list has in common with every one of the other."""
    both = [*left, *right]
    found, at = np.unique(np.concatenate(both), return_inverse=True)
    rows = np.repeat(np.arange(len(both)), [len(x) for x in both])
    shared = np.bincount(at, minlength=len(found)) > 1
    place = np.cumsum(shared) - 1
    rows, at = rows[shared[at]], place[at[shared[at]]]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        inside = (at >= low) & (at < low + COLUMNS)
        matrix = np.zeros((len(both), COLUMNS), dtype=np.float32)
        matrix[rows[inside], at[inside] - low] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return total


def spanning(pairs: list[tuple], roots: dict) -> list[tuple]:
    """Those of the pairs that join what the roots and the pairs before have not."""
    above: dict = {}

    def top(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    kept = []
    for a, b in pairs:
        ra, rb = top(roots[a]), top(roots[b])
        if ra != rb:
            above[ra] = rb
            kept.append((a, b))
    return kept


def block_links(members: DataFrame, similarity: float, together: int = TOGETHER) -> DataFrame:
    """Links (a, b) that join all similar rows (cluster, node, root, found) of a cluster; ``found`` is the set of shingles.

    The rows of a cluster are dealt to blocks of a stated size and each block meets each in a task of its own, which
    counts the common shingles of all its pairs and hands on only those that join something.
    """
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / together, F.sum(F.size("found")) / SHINGLES)).cast("int")
    sizes = members.groupBy("cluster").agg(blocks.alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = stored(dealt, "blocks")
    left = dealt.select("cluster", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), "node", "root", "found")
    right = dealt.filter("own > 0").select("cluster", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "node", "root", "found")

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*[table.column(c).to_pylist() for c in ("side", "node", "root")]))
        sets = [np.array(x, dtype=np.int64) for x in table.column("found").to_pylist()]
        a = [k for k, r in enumerate(rows) if r[0] == 0]
        same = table.column("i")[0] == table.column("j")[0]
        b = a if same else [k for k, r in enumerate(rows) if r[0] == 1]
        if not a or not b:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        common = common_counts([sets[k] for k in a], [sets[k] for k in b])
        size = np.array([len(s) for s in sets], dtype=np.float32)
        all_ = np.maximum(size[a][:, None] + size[b][None, :] - common, 1)
        root = np.array([r[2] for r in rows], dtype=np.int64)
        hits = np.argwhere((common / all_ >= similarity - 1e-6) & (root[a][:, None] != root[b][None, :]))
        pairs = [(rows[a[x]][1], rows[b[y]][1]) for x, y in hits.tolist() if not same or x < y]
        kept = spanning(pairs, {r[1]: r[2] for r in rows})
        return pa.table({"a": pa.array([min(p) for p in kept], pa.int64()), "b": pa.array([max(p) for p in kept], pa.int64())})

    return left.unionByName(right).groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def similar_links(nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (a, b) that join all of the rows (node, fp, sketch, size) which share an anchor and resemble each other.

    The texts of an anchor first meet the heaviest of them, which joins most of a large group of copies. Texts
    that share an anchor but are not joined yet form clusters, and within a cluster all are compared.
    """
    anchors = stored(rare_anchors(nodes).join(nodes.select("node", "fp", "size"), "node"), "anchors")
    possible = leader_pairs(anchors).filter(likely(similarity)).select("a", "b").distinct()
    rooted = stored(components(settled(possible, nodes, texts, words, similarity), "a", "b"), "roots")
    placed = stored(anchors.join(rooted, "node", "left").select("anchor", "node", F.coalesce("root", "node").alias("root")), "placed")
    apart = placed.groupBy("anchor").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    edges = placed.join(apart.select("anchor", "low"), "anchor").filter("root <> low").select(F.col("root").alias("a"), F.col("low").alias("b")).distinct()
    clusters = components(edges, "a", "b").select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    members = placed.select("node", "root").distinct().join(clusters, "root")
    found = texts.join(members, "node").select("cluster", "node", "root", shingle_sets(whole("text"), words).alias("found"))
    links = block_links(stored(found, "members"), similarity)
    return stored(links, "links").unionByName(rooted.select(F.col("node").alias("a"), F.col("root").alias("b")))


def drop_near_duplicates(df: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of a table read from files (doc_id, text, more) without near copies.

    Of each group that links of at least that resemblance join, the row with the smallest doc_id stays;
    null identifiers come last, then the order of the table decides. Texts without words are one group.
    """
    row = free_name(df, "__row")
    docs = numbered(df, row)
    prints = stored(docs.select(F.col(row).alias("__row"), "doc_id", sketched(whole("text"), words).alias("x")).select("__row", "doc_id", "x.*"), "sketches")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    copies = prints.groupBy("same").agg(F.min(place).alias("least"), F.min("__row").alias("node"))
    nodes = stored(copies.join(prints.select(F.col("__row").alias("node"), "fp", "sketch", "size"), "node"), "nodes")
    texts = docs.select(F.col(row).alias("node"), "text")
    rooted = components(similar_links(nodes, texts, words, similarity), "a", "b")
    placed = nodes.select("same", "node", "least").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stays = placed.groupBy("root").agg(F.min("least").alias("stays"))
    groups_of = placed.join(stays, "root").select("same", F.col("stays.__row").alias("stays"))
    gone = prints.select("__row", "same").join(groups_of, "same").filter("__row <> stays").select(F.col("__row").alias(row))
    return docs.join(stored(gone, "gone"), row, "left_anti").select(*df.columns)
