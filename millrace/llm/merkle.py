"""Merkle manifest of a dataset, with proofs by pointer jumping.

H is the lowercase hexadecimal SHA-256 of its inputs in a row, digests as hexadecimal text. A row is a leaf: H of its
columns, each ``-`` if null, else UTF-8 byte count, colon and value. Leaves of a language ascend by doc_id; every two
consecutive nodes, or a last single one, become their H until one is left, the subroot. Subroots in order of
their languages (null first, bytes of UTF-8) become the root in the same way.

Levels are built in blocks of 2 ** ``STEPS`` consecutive nodes, so one shuffle gives that many levels and no task holds
more than a block, however large a language is. Each node then holds the sibling on the way to its parent and a
pointer to it. A round joins the table with itself: a node takes the pointer of the node it points to and appends that
one's siblings to its own, which doubles the distance to its ancestor, until all leaves point beyond the root.
Nodes that nothing points to any more leave the table, so later rounds join with few rows.

Defined cases: an empty table has no rows. Null identifiers come first; rows with the same identifier are ordered by
their leaves, and equal rows are equal leaves. A null text is not an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import stored
from millrace.plans.numbering import number_rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Levels that one shuffle builds.
STEPS = 12
#: Tree that holds the subroots.
TOP = -1
# Path steps: no sibling, one to the left, one to the right; the digest follows.
NONE, LEFT, RIGHT = b"0", b"L", b"R"
NODE = "tree long, level int, idx long, digest binary, step binary, doc_id long, forged binary"


def leaf(values: dict[str, Column]) -> Column:
    """H of the values in order, as bytes."""
    text = {name: value.cast("string") for name, value in values.items()}
    parts = [F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in text.values()]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def h(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def ceil_log2(size: Column) -> Column:
    """Levels above ``size`` leaves: binary digits of size - 1."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0).cast("int")


def blocks(nodes: DataFrame, steps: int) -> DataFrame:
    """Rows (tree, depth, level, idx, digest, doc_id, forged) and the levels above them, ``steps`` at most.

    A node that has its parent in the block carries the step to it; the topmost ones have none.
    """
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("idx", "digest", "doc_id", "forged")]), key=lambda r: r[0])
        tree, depth, level = (table.column(c)[0].as_py() for c in ("tree", "depth", "level"))
        base, out = rows[0][0], []
        now = [r[1] for r in rows]
        extra = [(r[2], r[3]) for r in rows]
        for up in range(min(steps, depth - level) + 1):
            top = up == min(steps, depth - level)
            for i, d in enumerate(now):
                step = None
                if not top:
                    other = i ^ 1
                    step = NONE if other >= len(now) else (LEFT if other < i else RIGHT) + now[other]
                out.append((tree, level + up, (base >> up) + i, d, step, *(extra[i] if up == 0 else (None, None))))
            now = [h(*now[i : i + 2]) for i in range(0, len(now), 2)]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
        names = ["tree", "level", "idx", "digest", "step", "doc_id", "forged"]
        return pa.table({n: pa.array(c, t) for n, t, c in zip(names, types, zip(*out))})

    block = F.call_function("shiftright", F.col("idx"), F.lit(steps)).alias("block")
    return nodes.groupBy("tree", block).applyInArrow(run, NODE)


def grown(leaves: DataFrame, steps: int = STEPS) -> DataFrame:
    """All nodes of the trees over the leaves (tree, depth, idx, digest, doc_id, forged); a tree's last one has no step."""
    depths = leaves.select("tree", "depth").distinct()
    now, found = leaves.withColumn("level", F.lit(0)), None
    while True:
        out = stored(blocks(now, steps), "levels")
        ends = out.filter("step is null").join(depths, "tree")
        done = out.filter("step is not null").unionByName(ends.filter("level = depth").drop("depth"))
        found = done if found is None else found.unionByName(done)
        now = ends.filter("level < depth")
        if now.isEmpty():
            return found


def jumped(nodes: DataFrame, hops: int) -> DataFrame:
    """Leaves of all trees but the top one, with ``path``: the steps up to the root, after ``hops`` or fewer."""
    now, stride = nodes, 1
    while stride < hops:
        now = stored(now, "jumps")
        ahead = now.filter((F.col("tree") == TOP) | (F.col("level") % stride == 0)).select(
            F.col("tree").alias("pt"), F.col("level").alias("pl"), F.col("idx").alias("pi"),
            F.col("pt").alias("qt"), F.col("pl").alias("ql"), F.col("pi").alias("qi"), F.col("path").alias("further"),
        )
        stride *= 2
        needed = (F.col("tree") == TOP) | (F.col("level") % stride == 0)
        now = now.filter(needed).join(ahead, ["pt", "pl", "pi"], "left").select(
            "tree", "level", "idx", F.col("qt").alias("pt"), F.col("ql").alias("pl"), F.col("qi").alias("pi"),
            F.concat("path", F.coalesce("further", F.lit(b""))).alias("path"), "digest", "doc_id", "forged",
        )
    return now.filter((F.col("tree") != TOP) & (F.col("level") == 0))


def siblings(path: bytes) -> list[tuple[bytes, bytes]]:
    """(side, digest) of the steps of a path."""
    out, at = [], 0
    while at < len(path):
        side = path[at : at + 1]
        width = 0 if side == NONE else 32
        out.append((side, path[at + 1 : at + 1 + width]))
        at += 1 + width
    return out


def fold(start: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for side, other in siblings(path):
        start = h(start) if side == NONE else h(other, start) if side == LEFT else h(start, other)
    return start


def folded(start: Column, path: Column) -> Column:
    @F.arrow_udf("string")
    def run(starts: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([fold(s, p).hex() for s, p in zip(starts.to_pylist(), paths.to_pylist())], pa.string())

    return run(start, path)


def proof(path: Column) -> Column:
    """H of the siblings of a path."""

    @F.arrow_udf("string")
    def run(paths: pa.Array) -> pa.Array:
        return pa.array([h(*[d for side, d in siblings(p) if side != NONE]).hex() for p in paths.to_pylist()], pa.string())

    return run(path)


def digits(column: str) -> Column:
    return F.lower(F.hex(column))


def manifest(df: DataFrame, tampered: Column | None = None, steps: int = STEPS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``tampered`` says which rows have one added to n_chars before their proof is folded.
    """
    values = {c: F.col(c) for c in COLUMNS}
    more = values | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    hashed = stored(df.select("lang", "doc_id", leaf(values).alias("digest"), F.when(changed, leaf(more)).alias("forged")), "leaves")
    order = [F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), F.asc("digest"), F.asc_nulls_first("forged")]
    placed = number_rows(hashed, "at", order)
    sizes = placed.groupBy("lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    langs = stored(number_rows(sizes, "tree", [F.asc_nulls_first("lang")]).withColumn("tree", F.col("tree") - 1), "trees")
    leaves = placed.withColumnRenamed("lang", "own").join(langs, F.col("own").eqNullSafe(F.col("lang"))).select(
        "tree", ceil_log2(F.col("size")).alias("depth"), (F.col("at") - F.col("first")).alias("idx"), "digest", F.col("doc_id").cast("long").alias("doc_id"), "forged"
    )
    nodes = grown(leaves, steps)
    subroots = stored(nodes.filter("step is null").select("tree", "level", "digest"), "subroots")
    count, deepest = subroots.agg(F.count(F.lit(1)), F.coalesce(F.max("level"), F.lit(0))).first()
    above = grown(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), ceil_log2(F.lit(count)).alias("depth"), F.col("tree").alias("idx"), "digest",
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("forged"),
    ), steps)
    roots = above.filter("step is null").first()
    root = roots["digest"] if roots else b""

    # A subroot leads to its leaf of the top tree without a step; the root leads nowhere.
    ends, top = F.col("step").isNull(), F.col("tree") == TOP
    held = nodes.unionByName(above).select(
        "tree", "level", "idx",
        F.when(ends & ~top, F.lit(TOP)).when(~ends, F.col("tree")).cast("long").alias("pt"),
        F.when(ends & ~top, F.lit(0)).when(~ends, F.col("level") + 1).cast("int").alias("pl"),
        F.when(ends & ~top, F.col("tree")).when(~ends, F.call_function("shiftright", F.col("idx"), F.lit(1))).cast("long").alias("pi"),
        F.coalesce("step", F.lit(b"")).alias("path"), "digest", "doc_id", "forged",
    )
    # From a leaf: its tree's levels, the step over to the top tree, that one's levels, and off the root.
    paths = jumped(held, deepest + 1 + (max(count, 1) - 1).bit_length() + 1)
    known = paths.join(subroots.select("tree", digits("digest").alias("subroot")), "tree")
    rows = known.select(
        "doc_id", digits("digest").alias("leaf"), "subroot", F.lit(root.hex()).alias("root"), proof(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("forged", "digest"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampering(df: DataFrame) -> DataFrame:
    """The manifest, with every row tampered with whose crc32 of doc_id 7 divides."""
    return manifest(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)


#: The same in DuckDB: levels by a recursive query, proofs by the sibling of each level, crc32 bit by bit.
ORACLE = """
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
forms AS (
  SELECT *, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)) AS folded_crc,
         CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS middle,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS id,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang,
         sha256(id || middle || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || body) AS leaf,
         CASE WHEN xor(folded_crc, 4294967295) % 7 = 0
              THEN sha256(id || middle || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || body) END AS forged
  FROM forms),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) AS size FROM leaves GROUP BY lang),
placed AS (
  SELECT tree, size, doc_id, leaf, forged, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang),
low AS (
  SELECT tree, 0 AS level, idx, size, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM low
  WHERE size > 1 GROUP BY tree, level, idx // 2, size),
subroots AS (SELECT tree, digest AS subroot FROM low WHERE size = 1),
high AS (
  SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM subroots) AS size, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM high
  WHERE size > 1 GROUP BY level, idx // 2, size),
low_steps AS (
  SELECT a.tree, a.level, a.idx, CASE WHEN b.idx IS NULL THEN '0' WHEN b.idx < a.idx THEN 'L' || b.digest ELSE 'R' || b.digest END AS step
  FROM low a LEFT JOIN low b ON b.tree = a.tree AND b.level = a.level AND b.idx = xor(a.idx, 1) WHERE a.size > 1),
high_steps AS (
  SELECT a.level, a.idx, CASE WHEN b.idx IS NULL THEN '0' WHEN b.idx < a.idx THEN 'L' || b.digest ELSE 'R' || b.digest END AS step
  FROM high a LEFT JOIN high b ON b.level = a.level AND b.idx = xor(a.idx, 1) WHERE a.size > 1),
high_paths AS (
  SELECT s.tree, list(h.step ORDER BY h.level) FILTER (WHERE h.step IS NOT NULL) AS path
  FROM subroots s LEFT JOIN high_steps h ON h.idx = s.tree >> h.level GROUP BY s.tree),
low_paths AS (
  SELECT p.tree, p.idx, p.doc_id, p.leaf, p.forged, list(s.step ORDER BY s.level) FILTER (WHERE s.step IS NOT NULL) AS path
  FROM placed p LEFT JOIN low_steps s ON s.tree = p.tree AND s.idx = p.idx >> s.level GROUP BY ALL),
paths AS (
  SELECT l.doc_id, l.leaf, l.forged, subroot, (SELECT digest FROM high WHERE size = 1) AS root,
         list_concat(coalesce(l.path, []), coalesce(h.path, [])) AS path
  FROM low_paths l JOIN high_paths h USING (tree) JOIN subroots USING (tree)),
done AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(array_to_string(list_transform(list_filter(path, lambda x: x <> '0'), lambda x: x[2:]), '')) AS proof_sha256,
         list_reduce([coalesce(forged, leaf)] || path,
                     lambda d, x: sha256(CASE x[1] WHEN '0' THEN d WHEN 'L' THEN x[2:] || d ELSE d || x[2:] END)) AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM done
"""
