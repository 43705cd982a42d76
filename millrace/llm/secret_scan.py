"""Secret scan over nested encodings.

Every text is scanned, then unwrapped: percent escapes, Unicode escapes and character references are
replaced over a whole layer; each base64 run that decodes to text, or to a compressed stream that
inflates to text, is a layer of its own. Of a payload that is no text as a whole, each run of ASCII or of UTF-16 within
it is a layer: all that a secret or a further encoding consists of is ASCII. Layers go on a worklist until none is new; a layer whose
content and place were seen is not taken up again, so cycles end. Every layer carries the place in the
original text of each of its characters, so findings are given as spans of the original.

Defined cases: a null text is the empty one and has no findings; repeated rows and null identifiers
keep their rows; findings of one kind and span count once, the outermost layer's. A stream that inflates to
more than ``INFLATED`` bytes is inflated and scanned by windows of that size, which overlap by ``OVERLAP``, so it costs
bounded memory. Only such a stream whose content is a compressed stream once more is not opened; it is counted in
``unopened``.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import re
import zlib
from codecs import getincrementaldecoder
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import whole

KINDS = ("assign", "access", "hex")
# What counts as a secret. Letters of the keyword are ASCII in either case.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same runs as [0-9a-f]+ of 16 or more
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&\#[xX]([0-9A-Fa-f]{1,6});|&\#([0-9]{1,7});"
)
#: A run that may go on over single line breaks, if what stands before each is as long as a wrapped line.
BASE64 = re.compile(r"(?:[A-Za-z0-9+/_-]{16,}\r?\n)*[A-Za-z0-9+/_-]{16,}={0,2}|(?:[A-Za-z0-9+/_-]{16,}\r?\n)+[A-Za-z0-9+/_-]{1,15}={0,2}")
LINE_BREAK = re.compile(r"\r?\n")
SEPARATOR = re.compile(r"[/_-]+")
UNPRINTED = re.compile(r"[\x00-\x08\x0E-\x1F\x7F]")
#: Characters of a payload that show whether decoding all of it is worth while.
HEAD = 64
#: Bytes of a compressed layer that are held at a time, and those that two windows of a larger one share.
INFLATED, OVERLAP = 1 << 26, 1 << 20
#: Runs of text in a payload of mixed bytes: as long as the shortest secret, as ASCII or as UTF-16 of either order.
NARROW = re.compile(rb"[\x09-\x0D\x20-\x7E]{16,}")
WIDE = re.compile(rb"(?:[\x09-\x0D\x20-\x7E]\x00){16,}|(?:\x00[\x09-\x0D\x20-\x7E]){16,}")

FOUND = "struct<spans: array<struct<kind: string, start: int, stop: int, depth: int>>, unopened: int>"


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain matches: leftmost, non-overlapping for each kind."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(2, *m.span()) for m in HEX.finditer(text)]


class Layer:
    """A text and, unless it is the original, the original span of each of its characters."""

    def __init__(self, text: str, starts: np.ndarray | None = None, stops: np.ndarray | None = None, depth: int = 0):
        self.text, self.starts, self.stops, self.depth = text, starts, stops, depth

    def span(self, start: int, stop: int) -> tuple[int, int]:
        return (start, stop) if self.starts is None else (int(self.starts[start]), int(self.stops[stop - 1]))

    def key(self) -> bytes:
        place = self.span(0, len(self.text))
        return blake2b(f"{place}".encode() + self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def replaced(self, parts: list[tuple[int, int, list[tuple[str, int, int]]]]) -> "Layer":
        """A layer in which each part (start, end) has given way to characters with their own spans here."""
        starts = np.arange(len(self.text)) if self.starts is None else self.starts
        stops = np.arange(1, len(self.text) + 1) if self.stops is None else self.stops
        text, a, b, at = [], [], [], 0
        for start, stop, chars in parts:
            text.append(self.text[at:start])
            a.append(starts[at:start])
            b.append(stops[at:start])
            text += [c for c, _, _ in chars]
            a.append(starts[[s for _, s, _ in chars]])
            b.append(stops[[e - 1 for _, _, e in chars]])
            at = stop
        text.append(self.text[at:])
        a.append(starts[at:])
        b.append(stops[at:])
        return Layer("".join(text), np.concatenate(a), np.concatenate(b), self.depth + 1)


_unread: list[tuple[int, int]] = []


def _note(error: UnicodeDecodeError) -> tuple[str, int]:
    _unread.append((error.start, error.end))
    return "\ufffd", error.end


codecs.register_error("millrace.note", _note)


def read_bytes(data: bytes) -> list[tuple[str, int, int]]:
    """The characters of UTF-8 bytes with the bytes each stands for; what is malformed gives U+FFFD as in ``replace``."""
    _unread.clear()
    text = data.decode("utf-8", "millrace.note")
    malformed, out, at = dict(_unread), [], 0
    for c in text:
        stop = malformed.get(at, at + len(c.encode()))
        out.append((c, at, stop))
        at = stop
    return out


def percent_layer(layer: Layer) -> Layer | None:
    parts = []
    for m in PERCENT.finditer(layer.text):
        chars = read_bytes(bytes.fromhex(m[0].replace("%", "")))
        parts.append((*m.span(), [(c, m.start() + 3 * a, m.start() + 3 * b) for c, a, b in chars]))
    return layer.replaced(parts) if parts else None


def escape_layer(layer: Layer) -> Layer | None:
    parts: list[tuple[int, int, list]] = []
    for m in ESCAPE.finditer(layer.text):
        code = int(next(g for g in m.groups() if g), 10 if m[6] else 16)
        last = parts[-1] if parts else None
        if 0xDC00 <= code <= 0xDFFF and last and last[1] == m.start() and 0xD800 <= last[2][0][1] <= 0xDBFF:
            joined = 0x10000 + ((last[2][0][1] - 0xD800) << 10) + code - 0xDC00
            parts[-1] = (last[0], m.end(), [(chr(joined), joined)])
        else:
            parts.append((*m.span(), [(chr(code) if code < 0x110000 and not 0xD800 <= code <= 0xDFFF else "\ufffd", code)]))
    return layer.replaced([(a, b, [(c, a, b)]) for a, b, [(c, _)] in parts]) if parts else None


def inflate(data: bytes) -> tuple[bytes | None, bool]:
    """(content, too large) of a gzip or zlib stream, all its members, through streams within streams; None if there is none."""
    seen, opened = {data}, False
    while packed(data):
        parts, room = [], INFLATED
        # Members may follow each other; what is no member behind the last one is not part of the stream.
        while packed(data):
            try:
                stream = zlib.decompressobj(47)
                part = stream.decompress(data, room + 1)
            except zlib.error:
                if not parts:
                    return None, False
                break
            if len(part) > room:
                return None, True
            parts.append(part)
            room -= len(part)
            data = stream.unused_data
        data = b"".join(parts)
        if data in seen:
            return None, False
        seen.add(data)
        opened = True
    return (data if opened else None), False


class Stream:
    """A compressed stream, all its members, that is too large to be held inflated; its characters have one span."""

    def __init__(self, data: bytes, start: int, stop: int, depth: int):
        self.data, self.start, self.stop, self.depth = data, start, stop, depth

    def windows(self):
        """The content by windows of ``INFLATED`` bytes behind the ``OVERLAP`` before them."""
        data, held = self.data, b""
        while packed(data):
            stream = zlib.decompressobj(47)
            while not stream.eof and data:
                try:
                    part = stream.decompress(data, max(INFLATED + OVERLAP - len(held), 1))
                except zlib.error:
                    data = b""
                    break
                data, held = stream.unconsumed_tail, held + part
                if len(held) >= INFLATED + OVERLAP:
                    yield held
                    held = held[-OVERLAP:]
            data = stream.unused_data if stream.eof else b""
        yield held

    def layers(self, window: bytes) -> list["Layer"]:
        return flat_layers(window, self.start, self.stop, self.depth)


def flat_layers(content: bytes, start: int, stop: int, depth: int) -> list["Layer"]:
    """The layers of an inflated content: itself if it is text, or the runs of text in it; all with one span."""
    text = readable(content)
    texts = [text] if text else [run for run, _, _ in text_runs(content)]
    return [Layer(t, np.full(len(t), start), np.full(len(t), stop), depth) for t in texts]


def text_runs(data: bytes) -> list[tuple[str, int, int]]:
    """Runs of text in mixed bytes: (text, where it begins, bytes of a character)."""
    narrow = [(m[0].decode("ascii"), m.start(), 1) for m in NARROW.finditer(data)]
    return narrow + [(m[0].replace(b"\0", b"").decode("ascii"), m.start(), 2) for m in WIDE.finditer(data)]


def packed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] == 0x78 and not (data[0] * 256 + data[1]) % 31)


def readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not UNPRINTED.search(text) else None


def base64_starts(run: str) -> list[int]:
    """Where a payload may begin in a run: at each alignment of its start, and behind each group of separators."""
    starts = [0, 1, 2, 3, *(m.end() for m in SEPARATOR.finditer(run))]
    return [at for at in dict.fromkeys(starts) if len(run) - at >= 16 and promising(run[at : at + HEAD])]


def promising(head: str) -> bool:
    """Whether what a payload begins with decodes to a stream's mark or the beginning of a text."""
    data = decoded(head)
    if data is None or packed(data):
        return data is not None
    try:
        return not UNPRINTED.search(getincrementaldecoder("utf-8")().decode(data))
    except UnicodeDecodeError:
        return False


def decoded(chars: str) -> bytes | None:
    """The bytes of a base64 text, without a last character that stands for no byte."""
    run = chars.rstrip("=").translate({45: 43, 95: 47})
    run = run[: len(run) - (len(run) % 4 == 1)]
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4))
    except binascii.Error:
        return None


def base64_layers(layer: Layer) -> list[Layer | Stream]:
    out = []
    for m in BASE64.finditer(layer.text):
        breaks = [x.span() for x in LINE_BREAK.finditer(m[0])]
        lines = [(a, b) for a, b in zip([0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(m[0])])]
        # The lines as one run, then each line by itself, as they need not belong together.
        for wrapped in [lines, *([x] for x in lines if len(lines) > 1)]:
            chars = "".join(m[0][a:b] for a, b in wrapped)
            places = np.concatenate([np.arange(a, b) for a, b in wrapped]) + m.start()
            for at in base64_starts(chars):
                if new := base64_layer(layer, chars[at:], places[at:]):
                    out += new
                    break
            else:
                out += mixed_layers(layer, chars, places)
    return out


def base64_layer(layer: Layer, chars: str, places: np.ndarray) -> list[Layer | Stream]:
    """What a run decodes to, if it is text or a stream with text; ``places`` are those of its characters."""
    data = decoded(chars)
    if data is None:
        return []
    content, large = inflate(data)
    if content is not None or large:
        start, stop = layer.span(int(places[0]), int(places[-1]) + 1)
        return [Stream(data, start, stop, layer.depth + 1)] if large else flat_layers(content, start, stop, layer.depth + 1)
    if text := readable(data):
        ends = np.cumsum([len(c.encode()) for c in text])
        return [placed(layer, text, np.concatenate([[0], ends[:-1]]), ends, places)]
    return []


def mixed_layers(layer: Layer, chars: str, places: np.ndarray) -> list[Layer]:
    """The runs of text in a payload of mixed bytes, at each alignment of its start: any other start is one of these."""
    out = []
    for at in range(4):
        for text, first, width in text_runs(decoded(chars[at:]) or b""):
            begins = first + width * np.arange(len(text))
            out.append(placed(layer, text, begins, begins + width, places[at:]))
    return out


def placed(layer: Layer, text: str, begins: np.ndarray, ends: np.ndarray, places: np.ndarray) -> Layer:
    """A layer of characters that stand for these bytes of a base64 run."""
    # Byte i comes from the characters 4i // 3 to (4i + 3) // 3 of the run.
    a, b = places[begins * 4 // 3], places[(ends * 4 + 2) // 3 - 1]
    starts = a if layer.starts is None else layer.starts[a]
    stops = b + 1 if layer.stops is None else layer.stops[b]
    return Layer(text, starts, stops, layer.depth + 1)


def scan(text: str) -> tuple[list[tuple[int, int, int, int]], int]:
    """All findings as (start, kind, end, depth) in order, and the number of layers left unopened."""
    found: dict[tuple[int, int, int], int] = {}
    unopened = work_through([Layer(text)], found, set())
    return sorted((a, kind, b, depth) for (a, kind, b), depth in found.items()), unopened


def work_through(work: list[Layer | Stream], found: dict, seen: set) -> int:
    """Scan the layers and all that comes out of them; the number of streams left unopened."""
    unopened = 0
    while work:
        layer = work.pop(0)
        if isinstance(layer, Stream):
            for at, window in enumerate(layer.windows()):
                if not at and packed(window):
                    unopened += 1
                    break
                unopened += work_through(layer.layers(window), found, seen)
            continue
        for kind, start, stop in find_base(layer.text):
            a, b = layer.span(start, stop)
            found.setdefault((a, kind, b), layer.depth)
        inner = base64_layers(layer)
        if "%" in layer.text:
            inner.append(percent_layer(layer))
        if "\\" in layer.text or "&#" in layer.text:
            inner.append(escape_layer(layer))
        for new in inner:
            if isinstance(new, Stream):
                work.append(new)
            elif new is not None and new.text and (key := new.key()) not in seen:
                seen.add(key)
                work.append(new)
    return unopened


def secrets_of(text: Column) -> Column:
    """Findings of a text: ``spans`` (kind, start, stop, depth; 0 is the text itself) and ``unopened``."""

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            spans, unopened = scan(text)
            rows.append({
                "spans": [{"kind": KINDS[k], "start": a, "stop": b, "depth": d} for a, k, b, d in spans],
                "unopened": unopened,
            })
        return pa.array(rows, pa.struct([
            ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("depth", pa.int32())]))),
            ("unopened", pa.int32()),
        ]))

    return found(text)


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``secrets`` (ordered by start, then kind) and ``unopened``; columns so named are replaced."""
    return df.withColumn("__found", secrets_of(whole(df[text]))).withColumns(
        {"secrets": F.col("__found.spans"), "unopened": F.col("__found.unopened")}
    ).drop("__found")


def of_kind(spans: Column, kind: str) -> Column:
    """How many of the spans are of that kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digests(df: DataFrame) -> DataFrame:
    """Counts and digest of the plain matches and the list of all findings of every document."""
    found = find_secrets(df.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["depth"] == 0)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    return found.select(
        "doc_id",
        *[of_kind(base, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        "unopened",
    )
