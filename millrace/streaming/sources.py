"""Stream sources and payload decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.schemas import STREAM_SCHEMAS, STREAM_SETTINGS
from millrace.sources.tables import is_file


def kafka_options(feed: str, servers: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source (SRC-04); a limit per trigger only if the caller sets one."""
    s = STREAM_SETTINGS[feed]
    limit = {"maxOffsetsPerTrigger": str(max_per_trigger)} if max_per_trigger else {}
    return limit | {
        "kafka.bootstrap.servers": servers,
        "subscribe": s["topic"],
        "startingOffsets": "latest",
        "kafka.group.id": s["group"],
    }


def stream_source(
    spark: SparkSession, kind: str, feed: str, *, servers: str = "", path: str = "", files_per_trigger: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Unbounded table with a ``value`` column: Kafka where the connector is installed, else files.

    ``text`` reads JSON lines; ``parquet`` reads a table with a declared schema.
    """
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(feed, servers)).load()
    reader = spark.readStream.format(kind)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if schema is not None:
        reader = reader.schema(schema)
    folder, _, name = path.rpartition("/")
    if is_file(spark, path):  # the file source lists folders
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)


def decode(df: DataFrame, feed: str, keep_bad: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON payload to flat columns (SRC-05); bad JSON gives null fields.

    ``keep_bad`` adds the undecodable text as ``_corrupt_record``; ``keep`` names columns beside the payload
    that stay.
    """
    schema = STREAM_SCHEMAS[feed]
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    data = F.from_json(F.col("value").cast("string"), schema, options).alias("data")
    return df.select(*keep, data).select(*keep, "data.*")
