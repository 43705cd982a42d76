"""Phrase collocations from depth-truncated suffix subtrees, by vertical partitioning of word prefixes.

Texts are lower-cased in ASCII, cut into pieces at punctuation and line ends, and pieces into words at spaces and
tabs. A suffix is the words from a place on within its piece, at most ``DEPTH`` of them. The suffix tree of a
language is partitioned by prefixes (as ERA does): passes count the prefixes of one and of two words, and a prefix of
more than ``BUDGET`` occurrences is extended by a word, counted in a pass of its own, until none is left or the
depth is reached. Prefixes are dealt to groups by hash, so many that a group holds a quarter of the budget on average;
suffixes under a prefix that is itself too rare are left out, others end before a word that is too rare, and equal
suffixes of a task are combined before the shuffle. Each group then builds its subtrees alone, level by level:
a node's total is the sum of the leaves below it, and nodes below ``least`` are not opened. Prefixes of two words and
extended ones have their totals from the passes that counted them.

Words travel as 64-bit hashes, the ``SHORT`` most frequent ones as small numbers in their place. The pass that counts
words also shows whether two words share a code; then it starts anew with another seed, so totals are exact.
Frequent words, frequent prefixes and extended ones reach the tasks as tables and bit filters of a fixed size, whose
limits and false positives cost work only.

Scores: a candidate is a phrase of two words or more with at least ``least`` occurrences; of the cuts into two parts,
the one with the lowest floor(1000 * a * n / (l * r)) counts, then the earlier one. A candidate that lies in a longer
one with at least ``share`` percent of its occurrences is dropped; it is enough to look one word further, as the
phrases between have no fewer occurrences than the longer one.

Defined cases: null texts are empty, a null language is ``und``. An empty table gives no rows. Repeated rows count
as often as they stand. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.bits import bit_filter, held
from millrace.llm.texts import stored, whole

DEPTH, LEAST, TOP = 5, 100, 2000
#: Suffixes under one prefix above which it is extended; a group holds a quarter on average.
BUDGET = 1 << 20
#: Words that a task gathers before it combines and hands on, and word codes that it remembers.
ROOM, REMEMBERED = 1 << 20, 200_000
#: Frequent words with a short code.
SHORT = 1 << 18
#: Log of the bits of the filter of extended prefixes.
HOT_BITS = 23

MARK = b"\xff"  # no byte of UTF-8
# ASCII capitals become small, the ends of pieces a mark, tabs spaces.
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\n\x0b\x0c\r" + b"\t", b"abcdefghijklmnopqrstuvwxyz" + MARK * 10 + b" ")
CODES = [f"c{i + 1}" for i in range(DEPTH)]
ODD = np.uint64(0x9E3779B97F4A7C15)


def marked_words(text: bytes) -> list[bytes]:
    """The words of a text, with a mark between pieces."""
    return text.translate(FOLD).replace(MARK, b" \xff ").split()


class Coder(dict):
    """Code of each word as a signed number; zero is the mark. ``short`` holds hashes, whose places are short codes."""

    def __init__(self, seed: int, short: np.ndarray | None = None):
        super().__init__({MARK: 0})
        self.seed, self.words = seed, {}
        self.short = {} if short is None else {c: i for i, c in enumerate(short.tolist(), 1)}

    def __missing__(self, word: bytes) -> int:
        import xxhash

        code = xxhash.xxh64_intdigest(word, self.seed)
        code -= (code >> 63) << 64
        self[word] = code = self.short.get(code, code)
        self.words[code] = word
        return code

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
            self.words.clear()
            self[MARK] = 0


def gathered(batches, coder: Coder) -> Iterator[dict[str, np.ndarray]]:
    """Codes of the texts of batches (lang, text), a mark behind each text, by language."""
    parts: dict[str, list[np.ndarray]] = {}
    words = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = marked_words(text.as_py())
            found.append(MARK)
            parts.setdefault(lang, []).append(np.fromiter(map(coder.__getitem__, found), dtype=np.int64, count=len(found)))
            words += len(found)
            if words >= ROOM:
                yield {k: np.concatenate(v) for k, v in parts.items()}
                parts, words = {}, 0
                coder.trim()
    if parts:
        yield {k: np.concatenate(v) for k, v in parts.items()}


def mixed(lang: str, columns: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the prefixes of one word, two words and so on."""
    import xxhash

    keys, key = [], np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    for column in columns:
        key = (column.view(np.uint64) ^ key) * ODD
        key = key ^ (key >> np.uint64(32))
        keys.append(key)
    return keys


def prefixes(codes: np.ndarray, known: np.ndarray, lang: str, pairs: np.ndarray | None, depth: int) -> list[np.ndarray]:
    """Codes of the suffixes that go on to a second frequent word, zero from the first mark or rare word on.

    With a filter of pairs, only those under a frequent pair.
    """
    good = codes != 0
    good[good] = held(known, codes[good])
    at = np.flatnonzero(good[:-1] & good[1:])
    columns = [codes[at], codes[at + 1]]
    if pairs is not None:
        kept = held(pairs, mixed(lang, columns)[1])
        at, columns = at[kept], [c[kept] for c in columns]
    alive = np.ones(len(at), dtype=bool)
    for k in range(2, depth):
        there = np.minimum(at + k, len(codes) - 1)  # the last code is a mark
        alive &= good[there]
        columns.append(np.where(alive, codes[there], 0))
    return columns


def combined(columns: list[np.ndarray], keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows that are equal in all columns as one, and the number of each; those of one prefix stand together."""
    mix = (keys[-2] & np.uint64(0xFFFFFFFF << 32)) | (keys[-1] >> np.uint64(32))
    order = np.argsort(mix)
    columns = [c[order] for c in columns]
    if not len(order):
        return columns, np.zeros(0, dtype=np.int64)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def texts_of(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), whole(df["text"]).cast("binary").alias("text"))


def counted_words(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, hash, n) of every word."""

    def run(batches):
        coder = Coder(seed)
        for by_lang in gathered(batches, coder):
            for lang, codes in by_lang.items():
                found, n = np.unique(codes[codes != 0], return_counts=True)
                words = pa.array([coder.words[c] for c in found.tolist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(n), pa.string()), "word": words, "hash": found, "n": n})
            if 0 in coder.words:  # a word with the code of the mark: the seed is given up
                yield pa.RecordBatch.from_pydict({"lang": [""], "word": [""], "hash": pa.array([0], pa.int64()), "n": pa.array([0], pa.int64())})

    rows = texts.mapInArrow(run, "lang string, word string, hash long, n long")
    return stored(rows.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")), "words")


def one_to_one(words: DataFrame) -> bool:
    """Whether no two words share a hash, and none has that of the mark or of a short code."""
    doubles = words.groupBy("hash").agg(F.min("word").alias("low"), F.max("word").alias("high"))
    return doubles.filter((F.col("low") != F.col("high")) | F.col("hash").between(0, SHORT)).isEmpty()


def short_codes(frequent: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words, ``SHORT`` at most."""
    totals = frequent.groupBy("hash").agg(F.sum("n").alias("n"))
    return totals.orderBy(F.desc("n"), "hash").limit(SHORT).select("hash").toPandas()["hash"].to_numpy(dtype=np.int64)


class Pass:
    """What every task of a pass over the texts knows: the seed and the bounded tables."""

    def __init__(self, seed: int, short, known, pairs=None, hot=()):
        self.seed, self.short, self.known, self.pairs, self.hot = seed, short, known, pairs, list(hot)

    def suffixes(self, batches, depth: int) -> Iterator[tuple[str, list[np.ndarray]]]:
        pairs = self.pairs.value if self.pairs is not None else None
        for by_lang in gathered(batches, Coder(self.seed, self.short.value)):
            for lang, codes in by_lang.items():
                yield lang, prefixes(codes, self.known.value, lang, pairs, depth)

    def extended(self, keys: list[np.ndarray]) -> list[np.ndarray]:
        """From two words on, where the prefix is extended."""
        out, now = [], np.ones(len(keys[0]), dtype=bool)
        for key, filter_ in zip(keys[1:], self.hot):
            now = now & held(filter_.value, key)
            out.append(now)
        return out


def counted_prefixes(texts: DataFrame, told: Pass, depth: int) -> DataFrame:
    """(lang, c1 .., n) of the prefixes of ``depth`` words whose shorter ones from two words on are extended."""

    def run(batches):
        for lang, columns in told.suffixes(batches, depth):
            keep = columns[-1] != 0
            for further in told.extended(mixed(lang, columns)):
                keep = keep & further
            columns = [c[keep] for c in columns]
            kept, n = combined(columns, mixed(lang, columns))
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(n), pa.string())} | dict(zip(CODES, kept)) | {"n": n})

    names = CODES[:depth]
    rows = texts.mapInArrow(run, "lang string, " + ", ".join(f"{c} long" for c in names) + ", n long")
    return rows.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def keyed(rows: DataFrame, depth: int) -> DataFrame:
    """The rows (lang, c1 .., n) with the hash of their prefix as ``key``."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(depth)]
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            key = np.zeros(len(langs), dtype=np.uint64)
            for lang in set(langs.tolist()):
                own = langs == lang
                key[own] = mixed(lang, [c[own] for c in columns])[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], [*batch.schema.names, "key"])

    names = CODES[:depth]
    return rows.select("lang", *names, "n").mapInArrow(run, "lang string, " + ", ".join(f"{c} long" for c in names) + ", n long, key long")


def only_extended(rows: DataFrame, hot) -> DataFrame:
    """The rows whose key the filter holds."""

    def run(batches):
        for batch in batches:
            key = batch.column(batch.schema.get_field_index("key")).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(held(hot.value, key)))

    return rows.mapInArrow(run, rows.schema)


def dealt(texts: DataFrame, told: Pass, groups: int) -> DataFrame:
    """(lang, part, root, c1 .. , n): suffixes of three words or more with their group and the length of their prefix."""

    def run(batches):
        for lang, columns in told.suffixes(batches, DEPTH):
            longer = columns[2] != 0
            columns = [c[longer] for c in columns]
            columns, n = combined(columns, [mixed(lang, columns[:2])[1], mixed(lang, columns)[-1]])
            keys = mixed(lang, columns)
            root, key = np.full(len(n), 2, dtype=np.int32), keys[1].copy()
            for d, further in enumerate(told.extended(keys), 3):
                root[further] = d
                key[further] = keys[d - 1][further]
            # A suffix that ends in an extended prefix was counted with it.
            kept = np.sum([c != 0 for c in columns], axis=0) >= root
            part = (key % np.uint64(groups)).astype(np.int32)
            named = {"lang": pa.array([lang] * int(kept.sum()), pa.string()), "part": part[kept], "root": root[kept]}
            yield pa.RecordBatch.from_pydict(named | {c: x[kept] for c, x in zip(CODES, columns)} | {"n": n[kept]})

    rows = texts.mapInArrow(run, "lang string, part int, root int, " + ", ".join(f"{c} long" for c in CODES) + ", n long")
    return rows.repartition(groups, "lang", "part")


def subtree(columns: list[np.ndarray], root: np.ndarray, n: np.ndarray, least: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Nodes of three words and more of the subtrees of a group: their codes and totals, level by level."""
    order = np.lexsort((columns[1], columns[0]))
    columns, root, n = [c[order] for c in columns], root[order], n[order]
    above = np.cumsum(np.concatenate([[False], (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])]))
    for depth in range(3, len(columns) + 1):
        there = columns[depth - 1] != 0
        columns, root, n, above = [c[there] for c in columns], root[there], n[there], above[there]
        if not len(n):
            return
        last = columns[depth - 1]
        order = np.lexsort((last, above))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (last[order][1:] != last[order][:-1]) | (above[order][1:] != above[order][:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(n[order], at)
        # Above its prefix a group holds only part of a node: neither counted nor closed there.
        part = root[order][at] > depth
        full = (total >= least) & ~part
        yield [c[order][at][full] for c in columns[:depth]], total[full]
        above = np.empty(len(order), dtype=np.int64)
        above[order] = np.cumsum(new) - 1
        alive = (full | part)[above]
        columns, root, n, above = [c[alive] for c in columns], root[alive], n[alive], above[alive]


def subtrees(rows: DataFrame, least: int) -> DataFrame:
    """(lang, codes, a): the nodes of every group with at least that total."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        named = {name: table.column(name).to_numpy() for name in [*CODES, "root", "n"]}
        out: list[tuple[list, int]] = []
        for codes, total in subtree([named[c] for c in CODES], named["root"], named["n"], least):
            out += zip(np.stack(codes, axis=1).tolist(), total.tolist())
        return pa.table({
            "lang": pa.array([key[0].as_py()] * len(out), pa.string()),
            "codes": pa.array([c for c, _ in out], pa.list_(pa.int64())), "a": pa.array([a for _, a in out], pa.int64()),
        })

    return rows.groupBy("lang", "part").applyInArrow(run, "lang string, codes array<long>, a long")


def phrase_counts(df: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, word, code, n) of all words, and (lang, codes, a) of the phrases of two words up to ``DEPTH`` with that total."""
    spark = df.sparkSession
    share = spark.sparkContext.broadcast
    texts, seed = texts_of(df), 0
    words = counted_words(texts, seed)
    while not one_to_one(words):
        seed += 1
        words = counted_words(texts, seed)
    frequent = words.filter(F.col("n") >= least)
    short = short_codes(frequent)
    codes = spark.createDataFrame(list(zip(short.tolist(), range(1, len(short) + 1))), "hash long, short long")
    words = words.join(codes, "hash", "left").select("lang", "word", F.coalesce("short", "hash").alias("code"), "n")
    known = share(bit_filter(words.filter(F.col("n") >= least), "code"))

    told = Pass(seed, share(short), known)
    counts = stored(keyed(counted_prefixes(texts, told, 2).filter(F.col("n") >= least), 2), "pairs")
    told.pairs = share(bit_filter(counts, "key"))
    found = [counts]
    for depth in range(3, DEPTH + 1):
        heavy = counts.filter(F.col("n") > budget)
        if heavy.isEmpty():
            break
        told.hot.append(share(bit_filter(heavy, "key", HOT_BITS)))
        if depth > 3:
            found.append(only_extended(counts, told.hot[-1]))
        counts = stored(keyed(counted_prefixes(texts, told, depth).filter(F.col("n") >= least), depth), "longer")
    if len(told.hot) == DEPTH - 2:
        found.append(counts)  # whole suffixes: counted already, they open no subtree
    total = found[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    nodes = subtrees(dealt(texts, told, -(-total * 4 // budget) or 1), least)
    for rows in found:
        nodes = nodes.unionByName(rows.select("lang", F.array(*[c for c in rows.columns if c in CODES]).alias("codes"), F.col("n").alias("a")))
    return words, stored(nodes.distinct() if told.hot else nodes, "phrases")


def collocations(df: DataFrame, least: int = LEAST, top: int = TOP, share: int = 100, budget: int = BUDGET) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = phrase_counts(df, least, budget)
    frequent = words.filter(F.col("n") >= least)
    size = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = phrases.unionByName(frequent.select("lang", F.array("code").alias("codes"), F.col("n").alias("a")))
    longer = phrases.filter(F.size("codes") > 2).select(
        "lang", F.explode(F.array(F.expr("slice(codes, 1, size(codes) - 1)"), F.expr("slice(codes, 2, size(codes) - 1)"))).alias("codes"), "a"
    ).groupBy("lang", "codes").agg(F.max("a").alias("longer"))
    free = phrases.join(longer, ["lang", "codes"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    cuts = free.select("lang", "codes", "a", F.explode(F.expr("sequence(1, size(codes) - 1)")).alias("k")).withColumns(
        {"first": F.expr("slice(codes, 1, k)"), "rest": F.expr("slice(codes, k + 1, size(codes) - k)")}
    )
    left, right = parts.select("lang", F.col("codes").alias("first"), F.col("a").alias("l")), parts.select("lang", F.col("codes").alias("rest"), F.col("a").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(size, "lang")
    # 1000 * a * n and l * r stay below 38 digits, the quotient is at most ten times n.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    scored = both.withColumns({"over": (wide["a"] * 1000).cast("decimal(23,0)") * wide["n"], "under": wide["l"] * wide["r"]}).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "codes", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    placed = best.select("*", F.posexplode("codes").alias("i", "code")).join(frequent.select("lang", "code", "word"), ["lang", "code"])
    named = placed.groupBy("lang", "codes", "a", "n", "cut").agg(F.array_sort(F.collect_list(F.struct("i", "word")))["word"].alias("w"))
    rows = named.select("lang", F.array_join("w", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB: all phrases of up to five words, by shifted columns.
ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM listed),
spans AS (SELECT lang, ws, i, unnest(range(1, {DEPTH + 1})) AS k FROM places),
counts AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM spans
  WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING k = 1 OR count(*) >= {LEAST}),
sizes AS (SELECT lang, sum(a)::HUGEINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE k > 1 AND a >= {LEAST}),
free AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.a >= 100 * c.a
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, a, k, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM free),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:], ' ')
  JOIN sizes s ON s.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {TOP}
"""
