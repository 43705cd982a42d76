"""Exact dedup by a stateful stream.

Keys: one pass over a table of files writes for each row its digest (SHA-256 of the text without
ASCII white space), the code points of the original text and its content locator, that is its file and
the row in the file. A stream reads these keys and holds, per digest, the locator and identifier of the
row that stays and the number of rows. The state is in RocksDB on disk, checkpointed to the shared folder, and never
expires, so a later run of the stream goes on with new files. Rows of a batch are combined
before they are shuffled to the state: one digest with a third of all rows is one row of each task.

Hits, that is digests of several rows, are checked on full bytes: their texts are read through the
locator and compared. Rows whose digest agrees while the text does not are told apart by text.

Of equal texts stays the row with the most code points in its original text, then the smallest doc_id;
a null doc_id comes last, then the first file and row. Defined cases: null texts are empty and equal to all
texts of white space alone. Repeated rows are copies of each other. An empty folder gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.texts import SPACE, stored, whole
from millrace.session import scratch_path

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the stream: state on disk, whose files are not allotted ahead, so that small partitions of it stay small.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": STORE,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Size of a micro-batch of keys.
TRIGGER = {"maxBytesPerTrigger": str(16 << 30)}


def normal(text: Column | str) -> Column:
    """The text without ASCII white space."""
    return F.regexp_replace(whole(text), f"[{SPACE}]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def located(docs: DataFrame) -> DataFrame:
    """Rows of a file source under their content locator."""
    return docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


#: Order in which a group's rows stay: the least.
RANK = ("fewer", "unnamed", "doc_id", "file", "at")


def rank() -> Column:
    return F.struct((-F.col("chars")).alias("fewer"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "at")


def append_keys(docs: DataFrame, keys: str, digest=sha256) -> None:
    """Digest, locator and length of every row of a file source, added to the folder of keys."""
    located(docs).select(
        "doc_id", "file", "at", digest(normal("text")).alias("digest"), F.char_length(whole("text")).alias("chars"),
    ).write.mode("append").parquet(keys)


def advance(spark: SparkSession, keys: str, checkpoint: str, updates: str, **source) -> None:
    """Run the stream over the key files that it has not seen, and write the state of the digests they touch.

    A batch overwrites a folder of its own, so one that is run again after a failure changes nothing.
    ``source`` takes the options of the file source, such as maxFilesPerTrigger.
    """
    rows = spark.readStream.schema(spark.read.parquet(keys).schema).options(**source).parquet(keys)
    state = rows.groupBy("digest").agg(F.min(rank()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    spark.createDataFrame([], state.schema).write.mode("ignore").parquet(f"{updates}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    held = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).foreachBatch(write).start().awaitTermination()
    finally:
        for name, value in held.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def states(spark: SparkSession, updates: str) -> DataFrame:
    """The newest state of each digest: the one with the most rows."""
    return spark.read.parquet(updates).groupBy("digest").agg(
        F.max_by("best", "group_size").alias("best"), F.max("group_size").alias("group_size")
    )


def unlike_hits(rows: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Of the rows that share a digest, those whose digest stands for more than one text, with that text; None if
    there are none.

    The texts of the hits are read through their locators. All texts of a digest are equal, byte by
    byte, if the least is the greatest; each task combines its own first, so copies do not meet in one.
    """
    hits = rows.filter("group_size > 1").select("file", "at", "digest", "chars")
    texts = located(docs).join(hits, ["file", "at"]).withColumn("text", normal("text"))
    several = texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b")
    unlike = stored(several.select("digest"), "unlike")
    return None if unlike.isEmpty() else stored(texts.join(unlike, "digest"), "unlike-texts")


def assign(docs: DataFrame, digest=sha256, **source) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest of every row of a table read from files."""
    spark = docs.sparkSession
    keys, updates = scratch_path(spark, "keys"), scratch_path(spark, "states")
    append_keys(docs, keys, digest)
    advance(spark, keys, scratch_path(spark, "stream"), updates, **source)
    rows = stored(spark.read.parquet(keys).join(states(spark, updates), "digest"), "rows")
    if (unlike := unlike_hits(rows, docs)) is not None:
        apart = unlike.groupBy("digest", "text").agg(F.min(rank()).alias("best2"), F.count(F.lit(1)).alias("size2"))
        placed = unlike.join(apart, ["digest", "text"]).select("file", "at", "best2", "size2")
        rows = rows.join(placed, ["file", "at"], "left").withColumns(
            {"best": F.coalesce("best2", "best"), "group_size": F.coalesce("size2", "group_size")}
        )
    return rows.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        ((F.col("best.file") == F.col("file")) & (F.col("best.at") == F.col("at"))).alias("kept"), "digest",
    )


def duplicates(docs: DataFrame) -> DataFrame:
    """The decision on every document, by SHA-256."""
    return assign(docs, **TRIGGER).withColumnRenamed("digest", "text_sha256")


ORACLE = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS normal, length(coalesce(text, '')) AS chars FROM documents),
best AS (SELECT normal, arg_min(doc_id, {'c': -chars, 'd': doc_id}) AS keep_id, count(*) AS group_size FROM texts GROUP BY normal)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256
FROM texts JOIN best USING (normal)
"""
