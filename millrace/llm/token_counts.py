"""Token counts of fields and sections from one encoding of the whole document.

Each document is encoded once, so tokens are those that training sees, also where a token crosses from
one section to the next. The byte spans of its tokens follow from the tokens' lengths; they are joined
to the sections' intervals by a sorted merge, and a crossing token goes to exactly one section.

Rule for crossing tokens: a token belongs to the section that holds most of its bytes, of equal shares
the earlier one (``rule="largest"``); or to the section that holds its first byte (``rule="first"``).
A token of which no byte is in a section is in none and is counted in the row of section -1.

Sections are disjoint intervals of code points in ascending order. Empty ones hold no tokens. A null
text is empty: it has no tokens, and one empty section if sections are its lines. Repeated rows and
null identifiers keep their rows.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import whole

COUNTED = "struct<n_tokens: int, sections: array<struct<section: int, start: int, stop: int, n_tokens: int, n_crossing: int>>>"
_SECTIONS = pa.list_(pa.struct([(n, pa.int32()) for n in ("section", "start", "stop", "n_tokens", "n_crossing")]))


@lru_cache(maxsize=4)
def ranked(path: str, pattern: str):
    """The encoding of a rank file and the length in bytes of each of its tokens; one for each worker process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def byte_places(text: str) -> np.ndarray | None:
    """Byte offset of every code point and of the end; None if both agree."""
    if text.isascii():
        return None
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines in code points; a line feed belongs to the line that it ends."""
    feeds, at = [], text.find("\n")
    while at >= 0:
        feeds.append(at + 1)
        at = text.find("\n", at + 1)
    if feeds and feeds[-1] == len(text):
        feeds.pop()
    return np.array([0, *feeds]), np.array([*feeds, len(text)])


def attribute(lengths: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, -1 for none; whether it crosses a bound) from lengths and intervals in bytes."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    none = np.full(len(ends), -1)
    if not len(starts) or not len(ends):
        return none, none > 0
    first = np.searchsorted(starts, begins, side="right") - 1  # the last section that starts at or before the token
    inside = (first >= 0) & (begins < stops[np.maximum(first, 0)])
    crossing = ~inside | (ends > stops[np.maximum(first, 0)])
    owner = np.where(inside, first, -1)
    for i in np.flatnonzero(crossing):  # few tokens: those at a bound or in a gap
        low, best, most = max(first[i], 0), -1, 0
        touched = 0
        while low < len(starts) and starts[low] < ends[i]:
            share = min(ends[i], stops[low]) - max(begins[i], starts[low])
            if share > 0:
                touched += 1
                if share > most:
                    best, most = low, share
            low += 1
        crossing[i] = touched > 1 or 0 < most < lengths[i]
        owner[i] = best if rule == "largest" or (owner[i] < 0 and best >= 0 and starts[best] == begins[i]) else owner[i]
    return owner, crossing


def count_text(text: str, starts, stops, encoding, lengths, rule: str) -> dict:
    ids = np.asarray(encoding.encode_ordinary(text), dtype=np.int64)
    place = byte_places(text)
    a, b = (np.asarray(starts, dtype=np.int64), np.asarray(stops, dtype=np.int64))
    owner, crossing = attribute(lengths[ids], *((a, b) if place is None else (place[a], place[b])), rule)
    n = np.bincount(owner + 1, minlength=len(a) + 1).tolist()
    x = np.bincount(owner + 1, weights=crossing, minlength=len(a) + 1).astype(int).tolist()
    rows = zip(range(-1, len(a)), [0, *a.tolist()], [0, *b.tolist()], n, x)
    keys = ("section", "start", "stop", "n_tokens", "n_crossing")
    return {"n_tokens": len(ids), "sections": [dict(zip(keys, r)) for r in rows if r[0] >= 0 or r[3]]}


def counted(text: Column, path: str, pattern: str, sections: Column | None = None, rule: str = "largest") -> Column:
    """Tokens of a text and of its sections: array of struct<start, stop> in code points, or its lines if none are given."""
    if rule not in ("largest", "first"):
        raise ValueError(f"no rule {rule!r}")

    def run(texts: pa.Array, given: list | None) -> pa.Array:
        encoding, lengths = ranked(path, pattern)
        out = []
        for i, text in enumerate(texts.to_pylist()):
            if given is None:
                bounds = line_bounds(text)
            else:
                spans = given[i] or []
                bounds = ([s["start"] for s in spans], [s["stop"] for s in spans])
            out.append(count_text(text, *bounds, encoding, lengths, rule))
        return pa.array(out, pa.struct([("n_tokens", pa.int32()), ("sections", _SECTIONS)]))

    if sections is None:
        @F.arrow_udf(COUNTED)
        def lines(texts: pa.Array) -> pa.Array:
            return run(texts, None)

        return lines(text)

    @F.arrow_udf(COUNTED)
    def named(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return run(texts, spans.to_pylist())

    return named(text, sections)


def count_sections(
    df: DataFrame, path: str, pattern: str, text: str = "text", sections: str | None = None, rule: str = "largest"
) -> DataFrame:
    """The rows with ``n_tokens`` and ``section_tokens`` (an array by section); columns so named are replaced."""
    made = counted(whole(df[text]), path, pattern, df[sections] if sections else None, rule)
    return df.withColumn("__counted", made).withColumns(
        {"n_tokens": F.col("__counted.n_tokens"), "section_tokens": F.col("__counted.sections")}
    ).drop("__counted")


def count_fields(df: DataFrame, fields: list[str], path: str, pattern: str, separator: str = "\n", rule: str = "largest") -> DataFrame:
    """Fields of a row, null as empty, joined by the separator and encoded as one document.

    ``section_tokens`` then has the fields in the given order; the separator's own tokens are in no
    field (section -1) unless a token takes in a part of a field.
    """
    width = [F.char_length(whole(df[f])) for f in fields]
    starts, at = [], F.lit(0)
    for w in width:
        starts.append(at)
        at = at + w + F.lit(len(separator))
    spans = F.array(*[F.struct(a.cast("int").alias("start"), (a + w).cast("int").alias("stop")) for a, w in zip(starts, width)])
    joined = df.withColumns({"__joined": F.concat_ws(separator, *[whole(df[f]) for f in fields]), "__spans": spans})
    return count_sections(joined, path, pattern, "__joined", "__spans", rule).drop("__joined", "__spans")


def section_rows(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row for each line of each document."""
    done = count_sections(df.select("doc_id", "text"), path, pattern)
    return done.select("doc_id", F.col("n_tokens").cast("long").alias("doc_tokens"), F.inline_outer("section_tokens")).select(
        "doc_id", "section", "start", "stop", F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("n_crossing").cast("long").alias("n_crossing"), "doc_tokens",
    )
