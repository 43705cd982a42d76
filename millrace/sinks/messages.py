"""Outgoing event messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.numbering import number_rows
from millrace.schemas import ENVELOPES


def envelope(
    df: DataFrame, feed: str, order: list[str] | None = None, batch_size: int = 1, at: Column | None = None
) -> DataFrame:
    """Key and JSON value per row (SNK-11): numbered event id, time, producer, cycle and the row."""
    settings = ENVELOPES[feed]
    numbered = number_rows(df, "_no", order)
    when = F.current_timestamp() if at is None else at
    body = F.struct(
        F.format_string(f"{settings['prefix']}-%06d", "_no").alias("event_id"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.lit(feed).alias("producer"),
        (F.floor((F.col("_no") - 1) / batch_size) + 1).cast("int").alias("cycle"),
        *df.columns,
    )
    key = F.coalesce(F.col(settings["key"]).cast("string"), F.lit("unknown"))
    return numbered.select(key.alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def publish(messages: DataFrame, fmt: str, **options: str) -> None:
    """Write messages to Kafka, or to JSON files where no connector is installed."""
    if fmt == "kafka":
        messages.write.format("kafka").options(**options).save()
    else:
        messages.write.mode("append").format(fmt).save(options["path"])
