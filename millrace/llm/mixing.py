"""Mixing of sources to target weights through a tree of budgets.

Documents hang on the leaves of a tree (say domain, language, source). The token budget goes down the tree:
the children of a node share its budget by their weights, but a child takes no more than its capacity,
the tokens below it times ``max_epochs``. What a full child leaves goes to its siblings by their weights; only
when all of them are full does it go further up, to the siblings of their parent. In closed form: sorted
by capacity per weight, children are full up to some point, and the others divide the rest.

Each leaf then takes whole epochs while its budget holds a full pass, and of the next epoch the documents
at the front of a seeded order, up to the one that reaches the budget: it is taken if it starts before.
All numbers are integers, and a node's children get its budget to the token.

The order is that of a hash, so its first digits cut a leaf into buckets whose tokens are added up before
any are sorted: only the one bucket in which a leaf's budget ends is sorted, however large the leaf.

Defined cases: null keys are the key ``unknown``. Null texts have no tokens. Weights that are null or not
positive get nothing. A document without identifier is ordered by its text's hash. Rows that repeat an
identifier in one leaf stand at one place and are taken together. Nothing is selected from an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.texts import free_name, SPACE, stored, whole

#: Hexadecimal digits of the order that name a bucket.
DIGITS = 3


@dataclass(frozen=True)
class Level:
    """One level of the tree: its name, and as SQL the key of a document and the weight of a key (a positive
    integer; it may refer to the names of this and the upper levels)."""

    name: str
    key: str
    weight: str


def words_in(text: Column | str) -> Column:
    """Runs of anything but ASCII white space."""
    return F.regexp_count(whole(text), F.lit(f"[^{SPACE}]+")).cast("long")


def ordered(seed: int, epoch: Column) -> Column:
    """Place of a document in the order of an epoch, as hexadecimal digits."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.xxhash64(whole("text")).cast("string")))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name))


def share(nodes: DataFrame, parent: list[str], names: list[str]) -> DataFrame:
    """Budget of each node (``cap``, ``weight``) from that of its parent (``above``)."""
    fair = nodes.withColumn("fair", F.col("cap") / F.col("weight"))
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy("fair", *names)
    earlier, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    full = fair.withColumns({
        "capped": F.coalesce(F.sum("cap").over(earlier), F.lit(0)), "open": F.sum("weight").over(onward),
    }).withColumn("full", F.col("cap") * F.col("open") <= (F.col("above") - F.col("capped")) * F.col("weight"))
    rest = full.withColumns({
        "rest": F.col("above") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group),
        "open": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group),
        "upto": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    part = F.expr("rest * upto div nullif(open, 0) - rest * (upto - weight) div nullif(open, 0)")
    return rest.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(part)).select(*names, "budget")


def leaf_budgets(leaves: DataFrame, levels: list[Level], parts: int, of: int, max_epochs: int) -> DataFrame:
    """Budget of every leaf, from rows (level names, tokens); the whole budget is ``parts`` / ``of`` of all tokens."""
    names = [level.name for level in levels]
    weights = {f"weight_{x.name}": F.greatest(F.expr(x.weight).cast("long"), F.lit(0)) for x in levels}
    open_leaves = leaves.withColumns(weights).filter(
        (F.least(*weights, F.lit(1)) > 0) & (F.col("tokens") > 0)
    ).withColumn("cap", F.col("tokens") * max_epochs)
    above = None
    for depth, level in enumerate(levels):
        parent, path = names[:depth], names[: depth + 1]
        nodes = open_leaves.groupBy(*path).agg(
            F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap"), F.max(f"weight_{level.name}").alias("weight")
        )
        if above is None:  # one row for each key of the first level
            every = Window.partitionBy(F.lit(0))
            budget = F.expr(f"sum(tokens) over (partition by 0) * {parts} div {of}")
            nodes = nodes.withColumn("above", F.least(budget, F.sum("cap").over(every)))
        else:
            nodes = nodes.join(above.withColumnRenamed("budget", "above"), parent)
        above = share(nodes, parent, path)
    return above


def cuts(df: DataFrame, levels: list[Level], parts: int, of: int, max_epochs: int, seed: int) -> DataFrame:
    """Per leaf: its budget, whole epochs, and the last place taken of the epoch after them (null if none)."""
    names = [level.name for level in levels]
    sized = stored(df.select(
        *[F.expr(level.key).alias(level.name) for level in levels], words_in("text").alias("tokens"),
        F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"),
    ), "sized")
    leaves = sized.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    budgets = stored(
        leaves.join(leaf_budgets(leaves, levels, parts, of, max_epochs), names)
        .withColumns({"epochs": F.expr("budget div tokens"), "rest": F.expr("budget % tokens")}).drop("tokens"),
        "budgets",
    )
    placed = sized.join(budgets.filter("rest > 0"), names).withColumn("place", ordered(seed, F.col("epochs")))
    placed = placed.withColumn("bucket", F.substring("place", 1, DIGITS))
    buckets = placed.groupBy(*names, "bucket", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("bucket"))
    last = buckets.withColumn("upto", upto).filter("upto >= rest and upto - tokens < rest")
    last = last.select(*names, "bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("within"))
    inside = placed.join(last, [*names, "bucket"]).groupBy(*names, "place", "within").agg(F.sum("tokens").alias("tokens"))
    start = F.sum("tokens").over(Window.partitionBy(*names).orderBy("place")) - F.col("tokens")
    ends = inside.withColumn("start", start).filter("start < within").groupBy(*names).agg(F.max("place").alias("cut"))
    return stored(budgets.join(ends, names, "left").select(*names, "budget", "epochs", "cut"), "cuts")


def mix(
    df: DataFrame, levels: list[Level], parts: int = 9, of: int = 10, max_epochs: int = 1, seed: int = 7,
    epoch: str | None = "epoch", place: str | None = "place",
) -> DataFrame:
    """The selected rows, once for each epoch that takes them, with ``epoch`` and their ``place`` in its order.

    Columns of these two names are replaced; with None the rows have their own columns only. The rows of a leaf meet
    its few numbers in a join by the leaf's key. Spark broadcasts that table of leaves if its stored size allows,
    and else splits the join's skewed keys.
    """
    names = [free_name(df, f"__{level.name}") for level in levels]
    epochs, cut, now, at = (free_name(df, f"__{c}") for c in ("epochs", "cut", "epoch", "place"))
    tree = cuts(df, levels, parts, of, max_epochs, seed)
    tree = tree.select(*[F.col(level.name).alias(n) for level, n in zip(levels, names)], F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    keyed = df.withColumns({n: F.expr(level.key) for level, n in zip(levels, names)})
    passes = F.filter(F.sequence(F.lit(0), F.col(epochs).cast("int")), lambda e: (e < F.col(epochs)) | F.col(cut).isNotNull())
    each = keyed.join(tree, names).withColumn(now, F.explode(passes))
    taken = each.withColumn(at, ordered(seed, F.col(now))).filter((F.col(now) < F.col(epochs)) | (F.col(at) <= F.col(cut)))
    more = {epoch: F.col(now), place: F.col(at)}
    return taken.select(*[c for c in df.columns if c not in more], *[c.alias(n) for n, c in more.items() if n])


# The tree of the test tables: a source's domain follows from its number. Weights are the targets.
NUMBER = "regexp_extract(coalesce(source, ''), '[0-9]+', 0)"
TREE = [
    Level(
        "domain",
        f"case when {NUMBER} = '' then 'unknown' else element_at(array('web', 'books', 'forum'),"
        f" int((length({NUMBER}) * 7 + int(right({NUMBER}, 1))) % 3 + 1)) end",
        "case domain when 'web' then 5 when 'books' then 3 when 'forum' then 2 else 1 end",
    ),
    Level("lang", "coalesce(lang, 'unknown')", "case lang when 'en' then 4 when 'unknown' then 1 else 2 end"),
    Level("source", "coalesce(source, 'unknown')", "1"),
]


def mixture(df: DataFrame) -> DataFrame:
    """Selected documents of the test tables: up to two epochs of a leaf, for nine tenths of all tokens."""
    picked = mix(df.select("doc_id", "text", "lang", "source"), TREE, max_epochs=2)
    return picked.select("doc_id", "epoch", "place", *[F.expr(x.key).alias(x.name) for x in TREE], words_in("text").alias("n_tokens"))


def _level_sql(depth: int) -> str:
    names = ["domain", "lang", "source"]
    path, parent = ", ".join(names[: depth + 1]), ", ".join(names[:depth])
    group = f"PARTITION BY {parent}" if depth else ""
    weight = [
        "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END",
        "CASE lang WHEN 'en' THEN 4 WHEN 'unknown' THEN 1 ELSE 2 END",
        "1",
    ][depth]
    above = (
        f"JOIN (SELECT {parent}, budget AS above FROM b{depth - 1}) USING ({parent})" if depth
        else "CROSS JOIN (SELECT least(sum(tokens) * 9 // 10, sum(cap)) AS above FROM leaves)"
    )
    return f"""
n{depth} AS (SELECT {path}, sum(cap)::HUGEINT AS cap, ({weight})::HUGEINT AS weight FROM leaves GROUP BY {path}),
f{depth} AS (
  SELECT *, coalesce(sum(cap) OVER (g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM n{depth} {above}
  WINDOW g AS ({group} ORDER BY cap::DOUBLE / weight::DOUBLE, {path})),
b{depth} AS (
  SELECT {path}, CASE WHEN is_full THEN cap ELSE rest * upto // nullif(wide, 0) - rest * (upto - weight) // nullif(wide, 0) END AS budget
  FROM (
    SELECT *, above - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({group}) AS rest,
           sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({group}) AS wide,
           sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({group} ORDER BY cap::DOUBLE / weight::DOUBLE, {path}
                                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM (SELECT *, cap * open <= (above - capped) * weight AS is_full FROM f{depth})))"""


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         regexp_extract(coalesce(source, ''), '[0-9]+') AS number
  FROM documents),
keyed AS (
  SELECT doc_id, lang, source, n_tokens,
         CASE WHEN number = '' THEN 'unknown'
              ELSE (['web', 'books', 'forum'])[(length(number) * 7 + right(number, 1)::INT) % 3 + 1] END AS domain
  FROM docs),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * 2 AS cap
  FROM keyed GROUP BY domain, lang, source HAVING sum(n_tokens) > 0),{",".join(_level_sql(d) for d in range(3))},
passes AS (
  SELECT k.*, e.epoch, (b.budget // l.tokens) AS epochs, b.budget % l.tokens AS rest,
         md5('7:' || e.epoch || ':' || k.doc_id) AS place
  FROM keyed k JOIN leaves l USING (domain, lang, source) JOIN b2 b USING (domain, lang, source)
  CROSS JOIN (SELECT unnest(range(0, 3)) AS epoch) e),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY place) - n_tokens AS start FROM passes)
SELECT doc_id, epoch::INT AS epoch, place, domain, lang, source, n_tokens
FROM placed WHERE epoch < epochs OR (epoch = epochs AND start < rest)
"""
