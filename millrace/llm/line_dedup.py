"""Removal of repeated runs of lines, by winnowing.

Lines are compared without white space at their ends; lines without words are passed over. A gram is the
shortest run of whole lines from a line on that has ``NOISE`` words. A window is the shortest run from a
line on that has ``GUARANTEE`` words; of the grams inside it, the one with the least hash is a fingerprint of
its document. Two documents that share a run of ``GUARANTEE`` words or more hold the same window there
and so choose the same fingerprint. Each fingerprint is joined to its first occurrence (by doc_id, then
by place), and the match is extended line by line both ways. Lines in which an occurrence departs from the first are
held against the other earlier ones: all occurrences that agree up to such a line carry the same key for it, and of
these the first keeps it. So a line goes if any earlier occurrence agrees with this one from the fingerprint to it. The next fingerprint of a shared run is never
more than a window away, so an extension needs no more lines than those around the fingerprint, which it
carries along. The lines of the later run are deleted.

The first occurrence of a line is never deleted: a deleted line equals an earlier one.

Defined cases: null texts are empty and stay null. A document without identifier comes after all others,
repeated rows in the order of the table. Runs repeated inside one document count as well. Line feeds between
the lines that stay are kept; a document may become empty. Columns keep their names and order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.texts import SPACE, free_name, numbered, stored, whole

#: Words of the shortest run that is always found, and of the shortest that may be deleted.
GUARANTEE, NOISE = 50, 40


def lines_of(docs: DataFrame) -> DataFrame:
    """Lines with words of rows (__row, doc_id, text): place ``n``, hash ``h``, words ``w`` and words before it ``c``."""
    parts = docs.select("__row", "doc_id", F.posexplode(F.split(whole("text"), "\n")).alias("n", "line"))
    bare = parts.withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\x0c"))).filter("line <> ''")
    hashed = bare.select("__row", "doc_id", "n", F.unhex(F.md5("line")).alias("h"), F.size(F.split("line", f"[{SPACE}]+")).alias("w"))
    before = Window.partitionBy("__row").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return hashed.withColumn("c", F.coalesce(F.sum("w").over(before), F.lit(0)))


def ending(run: Column) -> Column:
    """Words of the document up to the end of a run of lines."""
    last = F.element_at(run, -1)
    return last["c"] + last["w"]


def fingerprints(lines: DataFrame, guarantee: int = GUARANTEE, noise: int = NOISE) -> DataFrame:
    """Chosen grams: (__row, doc_id, n, gram) with the lines from there on and those before it, nearest first."""
    by_words = Window.partitionBy("__row").orderBy("c")
    ahead = by_words.rangeBetween(0, guarantee - 1)
    line = F.struct("h", "w", "n", "c")
    stretched = lines.withColumns({
        "window": F.collect_list(line).over(ahead),
        "behind": F.reverse(F.collect_list(line).over(by_words.rangeBetween(-guarantee, -1))),
    })
    run = F.filter("window", lambda x: x["c"] < F.col("c") + noise)
    grams = stretched.withColumn("run", run).select(
        "__row", "doc_id", "n", "c", "behind",
        ending(F.col("window")).alias("stop"),
        F.when(ending(F.col("run")) >= F.col("c") + noise, F.struct(
            F.md5(F.array_join(F.transform("run", lambda x: F.hex(x["h"])), "")).alias("gram"), F.col("n"), ending(F.col("run")).alias("stop"),
        )).alias("gram"),
        F.concat(F.array(line), F.coalesce(F.lead("window").over(by_words), F.array().cast(lines.select(F.array(line)).schema[0].dataType))).alias("ahead"),
    )
    inside = F.filter(F.collect_list("gram").over(ahead), lambda g: g["stop"] <= F.col("stop"))
    least = F.when(F.col("stop") >= F.col("c") + guarantee, F.array_min(inside)["n"])
    # A gram is chosen by a window that starts at its line or before, less than the guarantee away.
    chosen = grams.withColumn("least", least).withColumn(
        "by", F.collect_set("least").over(by_words.rangeBetween(-guarantee, 0))
    ).filter(F.array_contains("by", F.col("n")))
    return chosen.select("__row", "doc_id", "n", F.unhex(F.col("gram.gram")).alias("gram"), "ahead", "behind")


def same_lines(a: str, b: str) -> Column:
    """How many lines from the first on agree."""
    agree = F.zip_with(a, b, lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False)))
    first_not = F.array_position(agree, False)
    return F.when(first_not > 0, first_not - 1).otherwise(F.size(agree)).cast("int")


def departing(side: str, agreed: str, mark: str) -> Column:
    """The lines of a side from the first departure on, each with a key of the gram and of all lines up to it."""
    def keyed(i: Column) -> Column:
        lines = F.transform(F.slice(side, F.col(agreed) + 1, i - F.col(agreed)), lambda x: F.hex(x["h"]))
        whole_key = F.concat(F.lit(mark), F.col(agreed).cast("string"), F.lit(":"), F.hex("gram"), F.array_join(lines, ""))
        return F.struct(F.unhex(F.md5(whole_key)).alias("key"), F.element_at(side, i)["n"].alias("line"))

    left = F.size(side) > F.col(agreed)
    return F.when(left, F.transform(F.sequence(F.col(agreed) + 1, F.when(left, F.size(side)).otherwise(F.col(agreed) + 1)), keyed))


def repeated_lines(docs: DataFrame, guarantee: int = GUARANTEE, noise: int = NOISE) -> DataFrame:
    """(__row, dropped): places of the lines to delete, of rows (__row, doc_id, text)."""
    prints = stored(fingerprints(lines_of(docs), guarantee, noise), "fingerprints")
    shared = prints.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("gram")
    met = prints.join(shared, "gram")
    place = lambda *more: F.struct(F.col("doc_id").isNull(), "doc_id", "__row", "n", *more)
    first = met.groupBy("gram").agg(F.min(place("ahead", "behind")).alias("first")).select(
        "gram", F.col("first.__row").alias("row1"), F.col("first.n").alias("n1"),
        F.col("first.ahead").alias("ahead1"), F.col("first.behind").alias("behind1"),
    )
    later = met.join(first, "gram").filter("__row <> row1 or n <> n1").select(
        "__row", "gram", "ahead", "behind", F.struct(F.col("doc_id").isNull(), "doc_id", "__row", "n").alias("place"),
        same_lines("ahead", "ahead1").alias("on"), same_lines("behind", "behind1").alias("back"),
    )
    none = F.array().cast("array<struct<key: binary, line: int>>")
    agreed = lambda side, upto: F.transform(
        F.slice(side, F.lit(1), F.col(upto)), lambda x: F.struct(F.lit(None).cast("binary").alias("key"), x["n"].alias("line"))
    )
    rows = stored(later.select("__row", "place", F.inline(F.concat(
        agreed("ahead", "on"), agreed("behind", "back"),
        F.coalesce(departing("ahead", "on", "a"), none), F.coalesce(departing("behind", "back", "b"), none),
    ))), "later-lines")
    keyed = rows.filter("key IS NOT NULL")
    holders = keyed.groupBy("key").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = keyed.join(holders.select("key", "first"), "key").filter("place <> first")
    gone = rows.filter("key IS NULL").select("__row", "line").unionByName(again.select("__row", "line"))
    gone = gone.select("__row", F.col("line").alias("n")).distinct()
    return gone.groupBy("__row").agg(F.collect_list("n").alias("dropped"))


def drop_repeats(df: DataFrame, guarantee: int = GUARANTEE, noise: int = NOISE, deleted: str | None = "lines_deleted") -> DataFrame:
    """The rows with ``text`` free of repeated runs and the number of deleted lines, replacing a column of that name.

    With ``deleted=None`` the rows have their own columns only.
    """
    row, dropped = free_name(df, "__row"), free_name(df, "__dropped")
    docs = numbered(df, row)
    gone = repeated_lines(docs.select(docs[row].alias("__row"), "doc_id", "text"), guarantee, noise).toDF(row, dropped)
    parts = F.split("text", "\n")
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(dropped)))
    cleaned = F.array_join(F.transform(kept, lambda i: parts[i]), "\n")
    names = [c for c in df.columns if c != deleted]
    text = F.when(F.col(dropped).isNull(), F.col("text")).otherwise(cleaned).alias("text")
    count = [F.coalesce(F.size(dropped), F.lit(0)).alias(deleted)] if deleted else []
    return docs.join(gone, row, "left").select(*[text if c == "text" else F.col(c) for c in names], *count)


def digests(df: DataFrame) -> DataFrame:
    """Lines deleted and the digest of what is left of every document."""
    return drop_repeats(df.select("doc_id", "text")).select(
        "doc_id", F.col("lines_deleted").cast("long").alias("lines_deleted"), F.md5(whole("text")).alias("text_md5"),
        F.char_length(whole("text")).cast("long").alias("n_chars"),
    )


#: The same in DuckDB: every stretch from a fingerprint to a line around it belongs to its earliest holder.
ORACLE = f"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS n
  FROM documents),
bare AS (SELECT doc_id, n, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM parts),
hashed AS (
  SELECT doc_id, n, md5(line) AS h, len(string_split_regex(line, '[\\x20\\x09-\\x0D]+')) AS w FROM bare WHERE line <> ''),
lines AS (
  SELECT *, coalesce(sum(w) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
  FROM hashed),
stretched AS (
  SELECT *, list({{'h': h, 'w': w, 'n': n, 'c': c}}) OVER ahead AS win,
         list({{'h': h, 'w': w, 'n': n, 'c': c}}) OVER behind AS behind
  FROM lines
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN CURRENT ROW AND {GUARANTEE - 1} FOLLOWING),
         behind AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN {GUARANTEE} PRECEDING AND 1 PRECEDING)),
runs AS (
  SELECT *, list_filter(win, lambda x: x.c < c + {NOISE}) AS run, win[-1].c + win[-1].w AS stop,
         lead(win) OVER (PARTITION BY doc_id ORDER BY c) AS next
  FROM stretched),
grams AS (
  SELECT doc_id, n, c, h, stop, run[-1].c + run[-1].w AS gram_stop,
         CASE WHEN run[-1].c + run[-1].w >= c + {NOISE}
              THEN md5(upper(array_to_string(list_transform(run, lambda x: x.h), ''))) END AS gram,
         list_concat([{{'h': h, 'w': w, 'n': n, 'c': c}}], coalesce(next, [])) AS ahead,
         list_reverse(coalesce(behind, [])) AS behind
  FROM runs),
chosen AS (
  SELECT DISTINCT a.doc_id, arg_min(b.n, {{'g': b.gram, 'n': b.n}}) AS n
  FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND b.c BETWEEN a.c AND a.c + {GUARANTEE - 1}
   AND b.gram IS NOT NULL AND b.gram_stop <= a.stop
  WHERE a.stop >= a.c + {GUARANTEE}
  GROUP BY a.doc_id, a.n),
prints AS (SELECT g.* FROM grams g JOIN chosen USING (doc_id, n)),
shared AS (SELECT gram FROM prints GROUP BY gram HAVING count(*) > 1),
reach AS (
  SELECT doc_id, p.n, 'a' AS side, ahead[i].n AS line, md5(gram || array_to_string(list_transform(ahead[1:i], lambda x: x.h), '')) AS key
  FROM prints p JOIN shared USING (gram), unnest(range(1, len(ahead) + 1)) AS t(i)
  UNION ALL
  SELECT doc_id, p.n, 'b', behind[i].n, md5(gram || array_to_string(list_transform(behind[1:i], lambda x: x.h), ''))
  FROM prints p JOIN shared USING (gram), unnest(range(1, len(behind) + 1)) AS t(i)),
earliest AS (SELECT side, key, min({{'d': doc_id, 'n': n}}) AS f FROM reach GROUP BY side, key),
gone AS (
  SELECT DISTINCT doc_id, line AS n FROM reach JOIN earliest USING (side, key) WHERE doc_id <> f.d OR n <> f.n),
left_over AS (
  SELECT p.doc_id, count(g.n) AS lines_deleted,
         coalesce(string_agg(p.line, chr(10) ORDER BY p.n) FILTER (WHERE g.n IS NULL), '') AS text
  FROM parts p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.n = g.n GROUP BY p.doc_id)
SELECT doc_id, lines_deleted, md5(text) AS text_md5, length(text) AS n_chars FROM left_over
"""
