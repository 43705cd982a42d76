"""WARC archives of pages: write, normalise, read back.

Write: every page is a record, as a line of a text table that Spark compresses, so each file is one gzip
stream over all its records. A payload seen before is a revisit that names the response holding it.

Normalise: an archive that is one gzip stream can only be read from its start. Each file is inflated
once, as a stream of lines, put together to records again, and every record is written as a gzip member of its
own. Beside each archive stands an index of the same name: place and length of every member with its
record's identifier, type, address and digest. Both come out of the same pass.

An archive is written by Spark's text writer without compression of its own. The writer ends each row
with a separator; a member below 16 MB ends in a zero byte (the high byte of its length), so that byte
is left off and the separator is a zero byte. A larger member is followed by an empty one, which ends in zero.
Index lines end in a zero byte for the same reason.

Of pages with equal payloads of at least ``LEAST`` bytes, that with the smallest page_id is the response; a null
page_id comes last, repeated rows follow the order of the table. Defined cases: null html is an empty payload, a
null or broken url is written without line breaks. An empty table makes no records. A truncated archive is an error.
"""

from __future__ import annotations

import hashlib
import json
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.texts import numbered, stored, whole
from millrace.session import scratch_path

LEAST = 100
#: Fixed date of capture where the table has none.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
EMPTY_MEMBER = zlib.compressobj(wbits=31).flush()


def first_seen(pages: DataFrame) -> DataFrame:
    """(__row, seen): for rows (__row, page_id, digest, size) that repeat a payload, the (page_id, __row) that holds it."""
    place = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "__row")
    holders = pages.filter(F.col("size") >= LEAST).groupBy("digest").agg(
        F.min(place).alias("seen"), F.count(F.lit(1)).alias("times")
    ).filter("times > 1")
    return pages.filter(F.col("size") >= LEAST).join(holders, "digest").filter("seen.__row <> __row").select("__row", "seen")


def record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), row.cast("string"), F.lit(">"))


def as_records(pages: DataFrame) -> DataFrame:
    """Column ``record``: the WARC record of every row (page_id, url, html), whole but for its last line feed."""
    rows = numbered(pages).select("__row", "page_id", "url", whole("html").alias("html"))
    sized = rows.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html")})
    known = stored(first_seen(stored(sized.select("__row", "page_id", "digest", "size"), "payloads")), "revisits")
    told = sized.join(known, "__row", "left")
    revisit = F.col("seen").isNotNull()
    url = F.regexp_replace(F.coalesce("url", F.lit("urn:unknown")), "[\r\n]+", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n")
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id"), F.col("__row")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Refers-To: "), record_id(F.col("seen.page_id"), F.col("seen.__row")), F.lit(f"\r\nWARC-Profile: {PROFILE}"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit("\r\n\r\n"),
    )
    return told.select(F.concat(head, block, F.lit("\r\n\r")).alias("record"))


def write_whole(records: DataFrame, path: str) -> None:
    """Archives of one gzip stream each."""
    records.write.option("compression", "gzip").option("lineSep", "\n").text(path)


class Records:
    """Puts the lines of an archive together to records."""

    def __init__(self, name: str):
        self.name, self.head, self.body, self.missing = name, [], [], 0

    def add(self, line: bytes):
        """The record (head lines, whole record) that this line completes, or None."""
        if self.missing:
            self.body.append(line)
            self.missing -= len(line) + 1
            if self.missing < 0:
                raise ValueError(f"{self.name}: a record is longer than its Content-Length")
            if self.missing == 0:
                whole_record = b"\n".join([*self.head, *self.body, b""])
                head, self.head, self.body = self.head, [], []
                return head, whole_record
        elif line not in (b"\r", b"") or self.head:
            self.head.append(line)
            if line == b"\r":
                self.missing = int(fields(self.head)["content-length"]) + 4
        return None

    def end(self) -> None:
        if self.head:
            raise ValueError(f"{self.name}: the last record is cut off")


def fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").rstrip("\r").partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def member(record: bytes) -> bytes:
    """The record as gzip members that end in a zero byte."""
    packer = zlib.compressobj(wbits=31)
    out = packer.compress(record) + packer.flush()
    return out if len(record) < 1 << 24 else out + EMPTY_MEMBER


MEMBERS = pa.schema([("kind", pa.string()), ("seq", pa.int64()), ("value", pa.binary())])


def _members(batches):
    """Archive rows and index rows of a task, from (file, line) in the order of the files."""
    records, offset, seq = None, 0, 0
    for batch in batches:
        kinds, seqs, values = [], [], []
        for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if records is None or records.name != name:
                if records:
                    records.end()
                records = Records(name)
            if (done := records.add(line)) is None:
                continue
            packed, head = member(done[1]), fields(done[0])
            entry = {
                "offset": offset, "length": len(packed), "record_id": head.get("warc-record-id"), "type": head.get("warc-type"),
                "uri": head.get("warc-target-uri"), "digest": head.get("warc-payload-digest"), "source": name,
            }
            kinds += ["archive", "index"]
            seqs += [seq, seq]
            values += [packed[:-1], json.dumps(entry).encode()]
            offset, seq = offset + len(packed), seq + 1
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(seqs, pa.int64()), pa.array(values, pa.binary())], schema=MEMBERS)
    if records:
        records.end()


def normalise(spark: SparkSession, path: str, out: str) -> None:
    """Rewrite archives of one gzip stream as archives of members (kind=archive) with their indexes (kind=index).

    A file is one task, as its stream has no other entry. Sorting by kind and number lets a task write its two
    files one after the other; it sorts on disk what does not fit into memory.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("line")
    )
    made = lines.mapInArrow(_members, "kind string, seq long, value binary").sortWithinPartitions("kind", "seq")
    made.select("kind", F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").partitionBy("kind").text(out)


INDEX = "offset long, length long, record_id string, type string, uri string, digest string, source string"


def written(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there; a normaliser without records writes none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def archive_files(spark: SparkSession, out: str) -> DataFrame:
    """(archive, content) of the normalised archives."""
    if not written(spark, f"{out}/kind=archive"):
        return spark.createDataFrame([], "archive string, content binary")
    files = spark.read.format("binaryFile").load(f"{out}/kind=archive")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """Index rows with the ``archive`` that each belongs to."""
    if not written(spark, f"{out}/kind=index"):
        return spark.createDataFrame([], f"archive string, {INDEX}")
    rows = spark.read.option("lineSep", "\0").text(f"{out}/kind=index")
    return rows.select(F.from_json("value", INDEX).alias("x"), F.col("_metadata.file_name").alias("archive")).select("archive", "x.*")


def parse(record: bytes) -> dict:
    """Header fields and payload of a record; of a response, length and digest are those of the payload itself."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = fields(head.split(b"\r\n"))
    http, _, payload = rest[: int(named["content-length"])].partition(b"\r\n\r\n")
    response = named["warc-type"] == "response"
    told = named["warc-payload-digest"].removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest() if response else told
    if digest != told:
        raise ValueError(f"{named['warc-record-id']}: the payload does not have its digest")
    return {
        "record_id": named["warc-record-id"], "type": named["warc-type"], "uri": named.get("warc-target-uri"),
        "digest": digest, "size": len(payload) if response else int(fields(http.split(b"\r\n"))["content-length"]),
        "refers_to": named.get("warc-refers-to"), "payload": payload if response else None,
    }


def inflated(data) -> list[bytes]:
    """The members of a gzip archive, one after the other, in time linear in its size."""
    view, at = memoryview(data), 0
    while at < len(view):
        stream, out = zlib.decompressobj(31), []
        while not stream.eof:
            part = view[at : at + CHUNK]
            if not part:
                raise ValueError("the archive is cut off")
            out.append(stream.decompress(part))
            at += len(part) - len(stream.unused_data)
        yield b"".join(out)


READ = "archive string, record_id string, type string, uri string, digest string, size long, refers_to string, payload binary"
_READ = pa.schema([(c, pa.binary() if c == "payload" else pa.int64() if c == "size" else pa.string()) for c in (x.split()[0] for x in READ.split(", "))])
#: Payload bytes that go to Spark at a time.
BATCH = 1 << 24


def _read(batches):
    for batch in batches:
        for name, data in zip(batch.column(0), batch.column(1)):
            rows, held = [], 0
            for record in inflated(data.as_buffer()):
                if record:
                    rows.append({"archive": name.as_py(), **parse(record)})
                    held += len(record)
                if held > BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def read_archives(spark: SparkSession, out: str) -> DataFrame:
    """Every record of the normalised archives."""
    return archive_files(spark, out).mapInArrow(_read, READ)


def read_at(spark: SparkSession, out: str, entries: DataFrame) -> DataFrame:
    """The records of some index rows: each archive is opened once and only those members are inflated."""
    wanted = entries.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("spans"))
    found = archive_files(spark, out).join(wanted, "archive")
    return found.select("archive", F.explode("spans").alias("span"), "content").select(
        "archive", F.substring("content", F.col("span.offset").cast("int") + 1, F.col("span.length").cast("int")).alias("content")
    ).mapInArrow(_read, READ)


def archived(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back the records of all pages; what the archives say of each."""
    spark = pages.sparkSession
    raw, out = scratch_path(spark, "warc-whole"), scratch_path(spark, "warc")
    write_whole(as_records(pages), raw)
    normalise(spark, raw, out)
    page = lambda c: F.regexp_extract(c, "^<urn:page:([^:]*):", 1).try_cast("long")
    return read_archives(spark, out).select(
        page("record_id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
    )


ORACLE = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
seen AS (SELECT payload_digest, min(page_id) AS first FROM payloads GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> first THEN first END AS refers_to
FROM payloads JOIN seen USING (payload_digest)
"""
