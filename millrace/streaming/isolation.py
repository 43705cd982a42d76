"""Batches of which only the bad rows are turned away."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.dates import stamp
from millrace.sinks.tables import _delete, dead_letter
from millrace.tenancy import Tenant, tag

#: Halvings after which rows that fail together are turned away together.
DEPTH = 40
# What a failing file system or connection says, in the text of its error.
STORAGE = ("java.io.", "No space left", "AccessControlException", "Connection refused", "SQLTransient", "SQLRecoverable")


def is_storage_error(error: Exception) -> bool:
    """Whether the place of writing failed, not the data."""
    return isinstance(error, OSError) or any(mark in str(error) for mark in STORAGE)


def attempts(rows: DataFrame, write: Callable[[DataFrame], None], depth: int = 0) -> Iterator[tuple[DataFrame, Exception]]:
    """Write the rows (with their hash ``__hash``); those that cannot be written come back with the error, the rest is stored.

    What fails is halved by the next bit of the hash until a row is alone, so one bad row of n costs about
    2 log2 n writes. Equal rows go together. An error of the storage is raised: the batch is tried again as a whole.
    """
    try:
        write(rows.drop("__hash"))
        return
    except Exception as error:
        if is_storage_error(error):
            raise
        failed = error
    if depth == DEPTH or rows.select("__hash").distinct().limit(2).count() < 2:
        yield rows.drop("__hash"), failed
        return
    bit = F.call_function("shiftright", F.col("__hash"), F.lit(depth)).bitwiseAND(F.lit(1))
    for side in (0, 1):
        half = rows.filter(bit == side)
        if not half.isEmpty():
            yield from attempts(half, write, depth + 1)


def checked(rows: DataFrame, accept: Callable[[pa.RecordBatch], None]) -> DataFrame:
    """The rows with ``__error``: what ``accept`` says of a row that it does not take, null for the others.

    Each task halves what is refused until a row is alone, so bad rows cost calls inside the tasks, not jobs.
    """
    kind = T.StructType([*rows.schema.fields, T.StructField("__error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, open_ = [None] * batch.num_rows, [(0, batch.num_rows)]
            while open_:
                start, size = open_.pop()
                try:
                    accept(batch.slice(start, size))
                except Exception as error:
                    if is_storage_error(error):
                        raise
                    if size == 1:
                        errors[start] = str(error)
                    else:
                        half = size // 2
                        open_ += [(start, half), (start + half, size - half)]
            names = [*batch.schema.names, "__error"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(errors, pa.string())], names=names)

    return rows.mapInArrow(run, kind)


@dataclass(frozen=True)
class IsolatingSink:
    """Writes each micro-batch once and turns away only the rows that cannot be written (SNK-09, SNK-10).

    Rows and dead letters of a batch have a folder named by the stream and the batch. The stream's name is its
    identifier, which a restart from the same checkpoint keeps and a new checkpoint changes: a replay empties its own
    folders and writes them again, and a stream that counts from zero anew overwrites nothing. ``write``
    gets some rows and the batch's folder and adds to it; a batch without rows leaves none.

    ``accept`` raises for an Arrow batch of rows that the store would refuse. It runs in the tasks, before ``write``, so any
    number of bad rows takes the same few jobs. Without it, or for rows that it lets pass, refused writes are
    halved, which suits few bad rows.
    """

    path: str
    dead_letter_path: str
    table: str
    tenant: Tenant
    write: Callable[[DataFrame, str], None] | None = None
    stream: str | None = None
    accept: Callable[[pa.RecordBatch], None] | None = None

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        stream = self.stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        place = f"stream={stream}/batch_id={batch_id}"
        folder, dead = f"{self.path}/{place}", f"{self.dead_letter_path}/{place}"
        for old in (folder, dead):
            _delete(spark, old)
        store = self.write or (lambda rows, to: rows.write.mode("append").parquet(to))
        rows = stamp(tag(df, self.tenant.company_id, self.tenant.factory_id, keep_existing=True), "created_at")
        rows = checked(rows, self.accept) if self.accept else rows.withColumn("__error", F.lit(None).cast("string"))
        rows = rows.withColumn("__hash", F.xxhash64(*df.columns)).persist()  # every attempt reads the same rows
        try:
            refused = rows.filter("__error IS NOT NULL").drop("__hash")
            if self.accept and not refused.isEmpty():
                dead_letter(refused, dead, self.table, F.col("__error"))
            taken = rows.filter("__error IS NULL").drop("__error")
            if not taken.isEmpty():
                for bad, error in attempts(taken, lambda some: store(some, folder)):
                    dead_letter(bad, dead, self.table, error)
        finally:
            rows.unpersist()
