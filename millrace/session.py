"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants. Shuffle width is left to adaptive execution: it starts wide and
# coalesces to the advisory size, so the same value serves one machine and a large cluster.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Folders that a task writes to at once.
WRITERS_CONF, WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 8

#: Shuffle files of a write go when it ends, not when the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A joined side whose shuffled partitions are all of at most this size, and of the advisory size at least, is hashed.
HASHED_CONF, ADVISORY_CONF = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def build_session(app_name: str = "millrace", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own; on a cluster a missing setting is an error, because a path on one
    machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint: the data lands in the shared folder, so executor loss costs nothing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def staged(df, label: str, by: list[str] | None = None, tidy: bool = False):
    """The rows written to the shared folder and read back: computed once, and of a size that the planner knows, so a
    small table is broadcast where a checkpoint of unknown size would shuffle the other side. ``by`` names columns whose
    values, a few, get folders of their own; their files are written side by side, so rows are not sorted for them.
    ``tidy`` is for rows behind wide joins: the long side is not sorted, so it does not spill, the shuffles are deleted
    once the rows are written, and these take less space for some seconds more."""
    path = scratch_path(df.sparkSession, label)
    conf = df.sparkSession.conf
    wanted = {WRITERS_CONF: WRITERS} if by else {}
    if tidy:
        wanted |= {CLEANUP_CONF: "true", HASHED_CONF: conf.get(ADVISORY_CONF)}
    held = {key: conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        df.write.partitionBy(*(by or [])).parquet(path, compression="zstd" if tidy else None)
    finally:
        for key, value in held.items():
            conf.set(key, value)
    return df.sparkSession.read.schema(df.schema).parquet(path)
