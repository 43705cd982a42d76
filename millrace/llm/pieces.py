"""SentencePiece encoding and decoding by a table of distinct chunks.

If no piece of the model holds a white space marker behind another character, a merge never crosses
from a character to a marker. Texts are cut there. The distinct chunks of all texts are counted in Spark. The most
frequent of those that recur, whose number and length are bounded, are segmented once, into a table in the shared
folder that goes to every task; their ids are put back by position. Any other chunk is segmented where it stands, once
for some texts: it is too rare to be met again soon, and to join it back by its spelling moves every text. So texts
never leave the task that read them, and the only shuffle is that of the counts.

The column functions (``encoder``, ``decoder``, ``round_trip``) do without the table: each worker keeps the chunks it met.

Defined cases: a null text is encoded as the empty one, which has no ids and decodes to the empty
text. Repeated rows and null identifiers keep their rows. A column with the name of a result is
replaced. A text of any length is encoded whole; a chunk without white space may be as long as the text.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import stored, whole

MARK = "▁"
#: Chunks that a task remembers from batch to batch. A full table starts anew: ids do not depend on it.
REMEMBERED = 200_000
#: Distinct chunks that are segmented by one call, and texts whose chunks are looked up together.
LINE, TEXTS = 256, 32

#: Most frequent chunks that every task holds, and their greatest length in characters.
HEAD, HEAD_CHARS = 262_144, 64
#: Steps of a doubling in which chunks are counted as equally frequent.
STEPS = 4

ROUND_TRIP = "struct<ids: array<int>, decoded: string>"


class ChunkTable:
    """Ids of distinct chunks, as bytes of 32-bit integers."""

    def __init__(self, model_path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.remembered = remembered
        self.ids: dict[str, bytes] = {}
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece of this model crosses a white space marker: chunks cannot be cut there")
        self.marked = np.array([piece.startswith(MARK) for piece in pieces])
        self._lead = self.model.encode("\n")
        if self.model.encode(" ") == self.model.encode(""):
            raise ValueError("this model drops white space: chunks cannot be cut there")
        self.cut = re.compile(f"{MARK}+[^{MARK}]*")

    def chunks(self, text: str) -> list[str]:
        """The text's chunks, each without the first of its markers."""
        if not text:
            return []
        words = text.split(" ")
        if MARK in text or "" in words:
            return [c[1:] for c in self.cut.findall(MARK + text.replace(" ", MARK))]
        return words

    def segment(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of each chunk."""
        found: dict[str, bytes] = {}
        # The model puts a marker ahead of what it encodes, so many chunks with one marker go as one
        # line: each starts where a piece has a marker.
        single = [c for c in chunks if c and c[0] != MARK]
        for at in range(0, len(single), LINE):
            some = single[at : at + LINE]
            ids = np.asarray(self.model.encode(" ".join(some)), dtype=np.int32)
            bounds = [*(np.flatnonzero(self.marked[ids]) * 4).tolist(), len(ids) * 4]
            raw = ids.tobytes()
            found.update(zip(some, [raw[a:b] for a, b in zip(bounds, bounds[1:])]))
        # Runs of markers go behind a line feed, whose ids are then taken off.
        for chunk in chunks.difference(single):
            ids = self.model.encode("\n" + MARK + chunk)
            found[chunk] = np.asarray(ids[len(self._lead):], dtype=np.int32).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as bytes of 32-bit integers."""
        out = []
        for at in range(0, len(texts), TEXTS):
            cut = [self.chunks(text) for text in texts[at : at + TEXTS]]
            new = set().union(*cut).difference(self.ids)
            if len(self.ids) + len(new) > self.remembered:
                self.ids.clear()
                new = set().union(*cut)
            self.ids.update(self.segment(new))
            out += [b"".join(map(self.ids.__getitem__, chunks)) for chunks in cut]
        return out


@lru_cache(maxsize=4)
def chunk_table(model_path: str) -> ChunkTable:
    """One table for each worker process."""
    return ChunkTable(model_path)


def as_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), dtype=np.int32)))


def encoder(model_path: str):
    """Arrow function: texts to lists of ids, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return as_lists(chunk_table(model_path).encode(texts.to_pylist()))

    return encode


def decoder(model_path: str):
    """Arrow function: lists of ids to texts; a null list gives the empty text."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array([chunk_table(model_path).model.decode(x or []) for x in ids.to_pylist()], pa.string())

    return decode


def round_trip(text: Column, model_path: str) -> Column:
    """Ids and the text that they decode to, from one pass over the text."""

    @F.arrow_udf(ROUND_TRIP)
    def both(texts: pa.Array) -> pa.Array:
        table = chunk_table(model_path)
        encoded = table.encode(texts.to_pylist())
        decoded = [table.model.decode(np.frombuffer(x, dtype=np.int32).tolist()) if x else "" for x in encoded]
        return pa.StructArray.from_arrays([as_lists(encoded), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return both(text)


def counted_chunks(texts: DataFrame, model_path: str) -> DataFrame:
    """(chunk, n) of the distinct chunks of the rows (text): counted in batches, then summed."""

    def run(batches):
        table = chunk_table(model_path)
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                seen.update(table.chunks(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["chunk", "n"])

    return texts.mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def segmented(chunks: DataFrame, model_path: str) -> DataFrame:
    """(chunk, n, ids) of rows (chunk, n) that recur, each segmented once. ``ids`` are bytes of 32-bit integers."""

    def run(batches):
        table = chunk_table(model_path)
        for batch in batches:
            for at in range(0, len(batch), LINE * 16):
                some = batch.slice(at, LINE * 16)
                names = some.column(0).to_pylist()
                ids = table.segment(set(names))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([ids[c] for c in names], pa.binary())], ["chunk", "n", "ids"])

    return stored(chunks.filter("n > 1").mapInArrow(run, "chunk string, n long, ids binary"), "pieces")


def head_of(table: DataFrame, size: int = HEAD, longest: int = HEAD_CHARS) -> DataFrame:
    """The most frequent chunks of the table up to a length, at most ``size``.

    Chunks are ranked by classes of frequency, which are few, so nothing is sorted: the head takes whole classes
    from the top. A chunk outside is short of no more than a class that does not fit, or longer than ``longest``.
    """
    level = F.floor(F.log2("n") * STEPS)
    short = table.filter(F.char_length("chunk") <= longest)
    least, held = None, 0
    for row in short.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("level")).collect():
        held += row.m
        if held > size:
            break
        least = row.level
    return short.limit(0) if least is None else short.filter(level >= least)


def put_back(rows: DataFrame, kind: str, head, model_path: str) -> DataFrame:
    """(row, ids, decoded) from rows (row, text): chunks of the head have their ids from it, others get them here."""

    def run(batches):
        table = chunk_table(model_path)
        known = head.value
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                some = batch.slice(at, TEXTS)
                cut = [table.chunks(text.as_py()) for text in some.column(1)]
                own = table.segment(set().union(*cut).difference(known))
                made = [b"".join([known[c] if c in known else own[c] for c in chunks]) for chunks in cut]
                yield result(some.column(0), made, table)

    return rows.mapInArrow(run, f"row {kind}, ids array<int>, decoded string")


def result(rows: pa.Array, encoded: list[bytes], table: ChunkTable) -> pa.RecordBatch:
    decoded = [table.model.decode(np.frombuffer(x, dtype=np.int32).tolist()) if x else "" for x in encoded]
    return pa.RecordBatch.from_arrays([rows, as_lists(encoded), pa.array(decoded, pa.string())], ["row", "ids", "decoded"])


def tokenize(
    df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
    keep: list[str] | None = None, head: int = HEAD,
) -> DataFrame:
    """The columns ``keep`` (all if not given) with the ids (array of int) and the text decoded from them.

    ``head`` bounds the chunks that go to every task; results do not depend on it. The frame is computed twice: for the
    counts, now, and for the result.
    """
    names = [c for c in (df.columns if keep is None else keep) if c not in (ids, decoded)]
    rows = df.select(F.struct(*[df[c] for c in names]).alias("row"), whole(df[text]).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    counts = stored(counted_chunks(rows.select("text"), model_path).filter("n > 1"), "chunks")
    table = segmented(head_of(counts, head), model_path)
    done = put_back(rows, kind, df.sparkSession.sparkContext.broadcast(as_dict(table)), model_path)
    return done.select(*[F.col("row")[c].alias(c) for c in names], F.col("ids").alias(ids), F.col("decoded").alias(decoded))


def as_dict(head: DataFrame) -> dict[str, bytes]:
    """Chunks of the head, whose number and length are bounded, with their ids."""
    got = head.select("chunk", "ids").toArrow()
    return dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))


def digests(df: DataFrame, model_path: str) -> DataFrame:
    """Count and digests of the ids and of the decoded text of every document."""
    return tokenize(df, model_path, keep=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
