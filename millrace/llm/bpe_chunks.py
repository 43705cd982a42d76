"""BPE encoding and decoding that reuses content-defined chunks.

A rolling hash over ``WINDOW`` characters cuts every text where the text itself says so, about every 2 ** ``BITS``
characters, so passages that documents share give the same chunks wherever they stand. A first pass counts chunk
hashes; those that occur again go into a bit filter of a fixed size. A text with none of them is encoded in place.
Of the other texts, each shared chunk is a reference to a table in which every distinct chunk is encoded once,
whatever lies between is encoded in place, and the ids are joined back by position.

Chunks cut words, so joins are repaired: each piece knows what stands before its first and behind its last ASCII
white space. At such a place no token, no normalisation and no added token of the model reaches across, so the ids
further inside are those of the whole text. What stands between, over as many pieces as have no white space, is
encoded once more; if that agrees with the pieces' own ids they stay, else it replaces them.

Where the model cuts Latin-1 strings into words by ``SPLITTING``, a worker keeps the ids that the library gave for a
word, of up to ``KNOWN`` words of up to ``SHORT`` characters, and looks them up when the word comes again in any string.

Defined cases: a null text is the empty one, without ids. Repeated rows and null identifiers keep their rows. Columns
named ``ids`` and ``decoded`` are replaced, any others may have any name. A text without cuts is cut at ``LONGEST``
characters. Added tokens in a text are found as the library finds them.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.bits import bit_filter, held
from millrace.llm.texts import stored, whole

WINDOW, BITS, LONGEST = 16, 10, 1 << 16
#: Texts that are encoded and handed on together.
TOGETHER = 256
#: Words whose ids a worker keeps (with more it begins anew) and the longest of them.
KNOWN, SHORT = 1 << 18, 32
#: The base of the rolling hash and its inverse modulo 2 ** 32, and characters that are hashed at a time.
BASE, BLOCK = 0x9E3779B1, 1 << 16

#: The normaliser that has a short cut for Latin-1 texts.
LOWERING = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
#: The pre-tokeniser whose words ``WORDS`` finds in Latin-1 texts that have been lowered.
SPLITTING = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
WORDS = re.compile("'(?:[stmd]|re|ve|ll)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")

# The ASCII white space.
SPACES = " \t\n\x0b\x0c\r"
#: ids: packed integers, of which ``head`` bytes come from ``front`` and ``tail`` bytes from ``back``; cut: whether there is white space.
PIECE = "struct<ids: binary, head: int, tail: int, front: string, back: string, cut: boolean>"


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    base, inverse = (np.full(BLOCK + WINDOW, x, dtype=np.uint32) for x in (BASE, pow(BASE, -1, 1 << 32)))
    base[0] = inverse[0] = 1
    return np.multiply.accumulate(base, dtype=np.uint32), np.multiply.accumulate(inverse, dtype=np.uint32)


def rolled(code: np.ndarray) -> np.ndarray:
    """Hash of each window of ``WINDOW`` characters, from differences of one running sum."""
    up, down = powers()
    size = len(code) - WINDOW + 1
    sums = np.zeros(len(code) + 1, dtype=np.uint32)
    np.cumsum(code * down[: len(code)], dtype=np.uint32, out=sums[1:])
    found = (sums[WINDOW:] - sums[:size]) * up[:size]
    found ^= found >> np.uint32(15)
    return found * np.uint32(0x85EBCA6B)


def chunk_ends(text: str, bits: int = BITS) -> list[int]:
    """Where the chunks of a text end."""
    marks: list[int] = []
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    below = np.uint32(1 << (32 - bits))
    for at in range(0, len(code) - WINDOW, BLOCK):
        found = rolled(code[at : at + BLOCK + WINDOW - 1])
        marks += (np.flatnonzero(found < below) + at + WINDOW).tolist()
    ends, at = [], 0
    for mark in [*marks, len(text)]:
        while mark - at > LONGEST:
            at += LONGEST
            ends.append(at)
        if mark > at:
            at = mark
            ends.append(at)
    return ends


def chunks(text: str, bits: int = BITS) -> list[str]:
    ends = chunk_ends(text, bits)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def keys_of(parts: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(p.encode()) for p in parts], dtype=np.uint64)


def digest(chunk: str) -> bytes:
    return blake2b(chunk.encode(), digest_size=16).digest()


class Encoder:
    """The library, with ids as bytes of integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        size = self.model.get_vocab_size()
        kept = json.loads(self.model.to_str())
        self.plain = None
        if kept["normalizer"] == LOWERING:
            self.added = [token["content"].lower() for token in kept["added_tokens"]]
            self.plain = Tokenizer.from_str(json.dumps(kept | {"normalizer": None}))
        self.packed = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.tokens = [self.model.id_to_token(i) for i in range(size)]
        last = kept["model"].get("end_of_word_suffix")
        self.wordwise = bool(self.plain and last and kept["pre_tokenizer"] == SPLITTING and all(a.split() == [a] for a in self.added))
        self.last = np.array([bool(last) and (token or "").endswith(last) for token in self.tokens])
        self.known: dict[str, bytes] = {}

    def lowered(self, text: str) -> str | None:
        """What the model's normaliser makes of a text but for the width of white space, which is no token; None if it is to do so.

        Latin-1 is composed already and has no lower case that depends on neighbours.
        """
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        low = text.lower()
        return None if any(a in low for a in self.added) else low

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids without special tokens. A normaliser that only lowers Latin-1 texts is done here, which costs it less."""
        low = [self.lowered(t) if self.plain else None for t in texts]
        rest = iter(self.library(self.model, [t for t, x in zip(texts, low) if x is None]))
        if self.wordwise:
            return [next(rest) if x is None else self.by_words(x) for x in low]
        some = iter(self.library(self.plain, [t for t in low if t is not None]) if self.plain else ())
        return [next(rest if x is None else some) for x in low]

    def library(self, model, texts: list[str]) -> list[bytes]:
        return [np.array(found.ids, dtype=self.packed).tobytes() for found in model.encode_batch_fast(texts, add_special_tokens=False)]

    def by_words(self, low: str) -> bytes:
        """Ids of a lowered text, those of its words one after another; words that are not known go to the library once."""
        words = WORDS.findall(low)
        new = list({*words}.difference(self.known))
        if new:
            self.known.update(zip(new, self.word_ids(new)))
        ids = b"".join(map(self.known.__getitem__, words))
        for word in new:
            if len(word) > SHORT:
                del self.known[word]
        if len(self.known) > KNOWN:
            self.known.clear()
        return ids

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word from one call: a word's last token is marked as such."""
        ids = self.library(self.plain, [" ".join(words)])[0]
        ends = (np.flatnonzero(self.last[self.numbers(ids)]) + 1) * self.packed.itemsize
        if len(ends) != len(words):
            return self.library(self.plain, words)
        return [ids[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def decode(self, ids: list[int]) -> str:
        """As the library's; without a decoder it puts spaces between tokens."""
        if self.model.decoder is None:
            return " ".join(map(self.tokens.__getitem__, ids))
        return self.model.decode(ids, skip_special_tokens=False)

    def pieces(self, texts: list[str]) -> list[dict]:
        """Every text as a piece."""
        parts, cut = [], []
        for text in texts:
            first = min((i for i in map(text.find, SPACES) if i >= 0), default=-1)
            last = max(map(text.rfind, SPACES))
            cut.append(first >= 0)
            parts += [text[:first], text[first : last + 1], text[last + 1 :]] if first >= 0 else [text, "", ""]
        ids = self.encode(parts)
        return [
            {"ids": a + b + c, "head": len(a), "tail": len(c), "front": parts[3 * i], "back": parts[3 * i + 2], "cut": cut[i]}
            for i, (a, b, c) in enumerate(zip(ids[::3], ids[1::3], ids[2::3]))
        ]

    def joined(self, rows: list[list[dict]]) -> list[bytes]:
        """The ids of texts given as lists of pieces, their joins repaired."""
        plans: list[list] = []
        windows: dict[str, bytes] = {}
        for row in rows:
            plan: list = []
            around, own, met = "", b"", 0
            for piece in row:
                ids = piece["ids"]
                head = piece["head"] if piece["cut"] else len(ids)
                around, own, met = around + piece["front"], own + ids[:head], met + 1
                if piece["cut"]:
                    plan += [(around, own, met > 1), ids[head : len(ids) - piece["tail"]]]
                    around, own, met = piece["back"], ids[len(ids) - piece["tail"] :], 1
            plan.append((around, own, met > 1))
            windows.update((p[0], b"") for p in plan if isinstance(p, tuple) and p[2])
            plans.append(plan)
        windows = dict(zip(windows, self.encode(list(windows))))
        out = []
        for plan in plans:
            settled = []
            for part in plan:
                if isinstance(part, tuple):
                    around, own, doubtful = part
                    part = windows[around] if doubtful and windows[around] != own else own
                settled.append(part)
            out.append(b"".join(settled))
        return out

    def numbers(self, ids: bytes) -> np.ndarray:
        return np.frombuffer(ids, dtype=self.packed)

    def result(self, encoded: list[bytes]) -> pa.Array:
        flat = self.numbers(b"".join(encoded)).astype(np.int32)
        offsets = np.cumsum([0, *(len(x) // self.packed.itemsize for x in encoded)], dtype=np.int32)
        decoded = [self.decode(self.numbers(x).tolist()) for x in encoded]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())], ["ids", "decoded"])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


def chunk_keys(texts: DataFrame, bits: int) -> DataFrame:
    """(key) of every chunk of the rows (text)."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                found = [keys_of(chunks(t, bits)) for t in batch.column(0).slice(at, TOGETHER).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["key"])

    return texts.mapInArrow(run, "key long")


def chunk_table(texts: DataFrame, known, path: str, bits: int) -> DataFrame:
    """(digest, piece) of every distinct chunk that may be shared, each encoded once."""

    def found(batches):
        for batch in batches:
            seen: dict[bytes, str] = {}
            for text in batch.column(0):
                parts = chunks(text.as_py(), bits)
                for i in np.flatnonzero(held(known.value, keys_of(parts))).tolist():
                    seen.setdefault(digest(parts[i]), parts[i])
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.string())], ["digest", "chunk"])

    def encoded(batches):
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                some = batch.slice(at, TOGETHER)
                made = encoder(path).pieces(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(made, piece_type())], ["digest", "piece"])

    distinct = texts.mapInArrow(found, "digest binary, chunk string").groupBy("digest").agg(F.first("chunk").alias("chunk"))
    return stored(distinct.mapInArrow(encoded, f"digest binary, piece {PIECE}"), "chunks")


def piece_type() -> pa.DataType:
    return pa.struct([("ids", pa.binary()), ("head", pa.int32()), ("tail", pa.int32()), ("front", pa.string()), ("back", pa.string()), ("cut", pa.bool_())])


def split_rows(batches, known, bits: int):
    """A few rows (id, row, text) at a time, with the chunks of their texts and which of those may be shared."""
    for batch in batches:
        for at in range(0, len(batch), TOGETHER):
            some = batch.slice(at, TOGETHER)
            parts = [chunks(t, bits) for t in some.column(2).to_pylist()]
            yield some, parts, [held(known.value, keys_of(p)) for p in parts]


def encoded_alone(rows: DataFrame, kind: str, known, path: str, bits: int) -> DataFrame:
    """(row, ids, decoded) of the texts without shared chunks."""

    def run(batches):
        for some, parts, shared in split_rows(batches, known, bits):
            alone = [not s.any() for s in shared]
            made = encoder(path).result(encoder(path).encode(["".join(p) for p, a in zip(parts, alone) if a]))
            yield pa.RecordBatch.from_arrays([some.filter(pa.array(alone)).column(1), *made.flatten()], ["row", "ids", "decoded"])

    return rows.mapInArrow(run, f"row {kind}, ids array<int>, decoded string")


def segments(rows: DataFrame, kind: str, known, path: str, bits: int) -> DataFrame:
    """(id, i, row, digest, piece) of the other texts: references to shared chunks and, between them, encoded pieces.

    The row stands with the first segment.
    """

    def run(batches):
        for some, parts, shared in split_rows(batches, known, bits):
            ids, places, first, digests_, pieces = [], [], [], [], []
            own: list[int] = []
            for at, (id_, texts, flags) in enumerate(zip(some.column(0).to_pylist(), parts, shared)):
                if not flags.any():
                    continue
                before, begin = False, len(ids)
                for text, flag in zip(texts, flags.tolist()):
                    if not flag and before:
                        pieces[-1] += text
                        continue
                    if not flag:
                        own.append(len(ids))
                    before = not flag
                    first.append(at if len(ids) == begin else None)
                    places.append(len(ids) - begin)
                    ids.append(id_)
                    digests_.append(digest(text) if flag else None)
                    pieces.append(None if flag else text)
            for at, piece in zip(own, encoder(path).pieces([pieces[i] for i in own])):
                pieces[at] = piece
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int32()), some.column(1).take(pa.array(first, pa.int64())), pa.array(digests_, pa.binary()), pa.array(pieces, piece_type())],
                ["id", "i", "row", "digest", "piece"],
            )

    return rows.mapInArrow(run, f"id long, i int, row {kind}, digest binary, piece {PIECE}")


def encoded_pieces(rows: DataFrame, kind: str, path: str) -> DataFrame:
    """(row, ids, decoded) from rows (row, pieces in order)."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                some = batch.slice(at, TOGETHER)
                made = encoder(path).result(encoder(path).joined(some.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([some.column(0), *made.flatten()], ["row", "ids", "decoded"])

    return rows.mapInArrow(run, f"row {kind}, ids array<int>, decoded string")


def tokenize(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """The columns ``keep`` (all if not given) with ``ids`` (array of int) and ``decoded``."""
    names = [c for c in (df.columns if keep is None else keep) if c not in ("ids", "decoded")]
    rows = df.select(F.monotonically_increasing_id().alias("id"), F.struct(*[df[c] for c in names]).alias("row"), whole(df[text]).alias("text"))
    kind, texts = rows.schema["row"].dataType.simpleString(), rows.select("text")
    counts = chunk_keys(texts, bits).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = df.sparkSession.sparkContext.broadcast(bit_filter(counts.filter("n > 1"), "key"))
    single = encoded_alone(rows, kind, known, path, bits)

    table = chunk_table(texts, known, path, bits).withColumnRenamed("piece", "shared")
    met = segments(rows, kind, known, path, bits).join(table, "digest", "left")
    piece = F.struct("i", F.coalesce("piece", "shared").alias("piece"))
    gathered = met.groupBy("id").agg(F.first("row", ignorenulls=True).alias("row"), F.collect_list(piece).alias("parts"))
    in_order = F.array_sort("parts", lambda a, b: a["i"] - b["i"])["piece"]
    several = encoded_pieces(gathered.select("row", in_order.alias("parts")), kind, path)
    return single.unionByName(several).select("row.*", "ids", "decoded")


def digests(df: DataFrame, path: str) -> DataFrame:
    """Count and digests of the ids and of the decoded text of every document."""
    return tokenize(df, path, keep=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
