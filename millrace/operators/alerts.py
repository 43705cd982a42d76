"""Alerts as table rows: events, per-tenant summaries, market-wide fan-out, routing, inbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import series, text
from millrace.plans.scalars import with_thresholds
from millrace.schemas import ALL_FACTORIES, TENANT_KEYS

# Fixed value: rows that a summary shows; all of them are event rows.
PREVIEW_ROWS = 10

# Inbox titles by event type.
TITLES = {"price_spike": "Price Spike Detected", "low_efficiency": "Low Production Efficiency"}


def inbox_title(event_type: str) -> str:
    return TITLES.get(event_type, f"Alert: {event_type}")


def _order(cols: list[str], order: list[str] | None) -> list[Column]:
    """Total order of the sample: the asked columns, then every shown column."""
    return [F.col(c) for c in dict.fromkeys([*(order or []), *cols])]


def _sample_json(cols: list[str], order: list[str] | None) -> Column:
    """Aggregate: the rows of a bounded sample as one ordered JSON array."""
    ranked = F.struct(F.struct(*_order(cols, order)).alias("rank"), F.struct(*cols).alias("row"))
    rows = F.transform(F.array_sort(F.collect_list(ranked)), lambda r: r["row"])
    return F.to_json(rows, {"ignoreNullFields": "false"})


def alert_events(
    df: DataFrame, event_type: str, cols: list[str], keys: list[str] | None = None
) -> DataFrame:
    """One event row per anomaly (ALR-01)."""
    keys = TENANT_KEYS if keys is None else keys
    return df.select(F.lit(event_type).alias("event_type"), *keys, text.row_json(cols).alias("payload"))


def tenant_summaries(
    df: DataFrame, event_type: str, cols: list[str], order: list[str] | None = None, preview_rows: int = PREVIEW_ROWS
) -> DataFrame:
    """One inbox row per tenant with the number of its anomalies and the first of them (ALR-02, SNK-16).

    The preview is bounded per tenant before it is gathered, so a hot tenant stays small; the whole
    set is the event table.
    """
    totals = df.groupBy(*TENANT_KEYS).agg(F.count(F.lit(1)).alias("row_count"))
    shown = series.first_rows(df, TENANT_KEYS, _order(cols, order), preview_rows)
    samples = shown.groupBy(*TENANT_KEYS).agg(_sample_json(cols, order).alias("detail_json"))
    return totals.join(samples, TENANT_KEYS).select(
        *TENANT_KEYS,
        F.lit(event_type).alias("event_type"),
        F.lit(inbox_title(event_type)).alias("title"),
        "detail_json",
        "row_count",
        F.lit(False).alias("email_sent"),
    )


def market_alert(
    df: DataFrame, event_type: str, cols: list[str], order: list[str], subscriptions: DataFrame,
    preview_rows: int = PREVIEW_ROWS,
) -> DataFrame:
    """Market-wide alert for every enabled tenant (ALR-03, JN-09).

    The anomalies shrink to one summary row, which every tenant row reads as a scalar subquery: no
    join and no product of rows. Without anomalies there is no alert.
    """
    sample = df.orderBy(*_order(cols, order)).limit(preview_rows).agg(_sample_json(cols, order).alias("detail_json"))
    summary = with_thresholds(df.agg(F.count(F.lit(1)).alias("row_count")), sample)
    tenants = subscriptions.filter("enabled").select(*TENANT_KEYS).distinct()
    return (
        with_thresholds(tenants, summary)
        .filter("row_count > 0")
        .select(
            *TENANT_KEYS,
            F.lit(event_type).alias("event_type"),
            F.lit(inbox_title(event_type)).alias("title"),
            "detail_json",
            "row_count",
            F.lit(False).alias("email_sent"),
        )
    )


def recipients(tenants: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Address per alerted tenant: its own subscription, else the company-wide one (JN-08).

    Two equi-joins on small sides replace the search among both kinds of row.
    """
    live = subscriptions.filter("enabled")
    own = live.groupBy(*TENANT_KEYS).agg(F.min("notify_email").alias("own_email"))
    shared = (
        live.filter(F.col("factory_id") == ALL_FACTORIES)
        .groupBy("company_id")
        .agg(F.min("notify_email").alias("company_email"))
    )
    return (
        tenants.join(own, TENANT_KEYS, "left")
        .join(shared, "company_id", "left")
        .withColumn("notify_email", F.coalesce("own_email", "company_email"))
        .drop("own_email", "company_email")
    )


def low_efficiency_lines(lines: DataFrame, limit_pct: float = 70.0) -> DataFrame:
    """ALR-04."""
    return lines.filter(F.col("avg_efficiency") < limit_pct)


def channel(event_type="event_type") -> Column:
    """Where an alert goes (ALR-05). Event types and channels."""
    col = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.when(col == "price_spike", "market").when(col == "low_efficiency", "ops").otherwise("management")


def _shown(*cols) -> Column:
    """First present value as text, or a question mark."""
    return F.coalesce(*[F.col(c).cast("string") for c in cols], F.lit("?"))


def message(df: DataFrame) -> DataFrame:
    """Title, detail and severity of an event row (STR-02). The wording."""
    kind = F.col("event_type")
    moved = F.format_string(
        "steel moved %s%% on %s (now %s EGP).",
        _shown("price_change_pct"),
        F.coalesce(F.col("date").cast("string"), F.lit("latest tick")),
        _shown("steel_price_egypt_egp"),
    )
    running = F.format_string(
        "%s is running at %s%%.",
        F.coalesce(F.col("facility"), F.col("production_line"), F.lit("A line")),
        _shown("avg_efficiency"),
    )
    slow = kind.isin("low_efficiency", "line_efficiency_low")
    return df.withColumns(
        {
            "title": F.when(kind == "price_spike", "Steel price spike")
            .when(slow, "Factory efficiency below 70%")
            .otherwise(F.concat(F.lit("Alert: "), kind)),
            "detail": F.when(kind == "price_spike", moved).when(slow, running).otherwise(kind),
            "severity": F.when(kind == "price_spike", "high").otherwise("warning"),
        }
    )


def inbox(alerts: DataFrame, tenant, unseen_only: bool = False, limit: int = 50) -> DataFrame:
    """Newest alerts of one tenant (TOP-08)."""
    mine = alerts.filter((F.col("company_id") == tenant.company_id) & (F.col("factory_id") == tenant.factory_id))
    if unseen_only:
        mine = mine.filter(~F.col("seen"))
    return mine.orderBy(F.desc("created_at"), F.desc("id")).limit(limit)


def inbox_counts(rows: DataFrame) -> DataFrame:
    """AGG-39."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.coalesce("seen", F.lit(False))).alias("unseen")
    )


def mark_seen(alerts: DataFrame, tenant, alert_id: int | None = None) -> DataFrame:
    """One alert, or all of the tenant, marked as seen (SNK-17)."""
    hit = (F.col("company_id") == tenant.company_id) & (F.col("factory_id") == tenant.factory_id)
    if alert_id is not None:
        hit = hit & (F.col("id") == alert_id)
    return alerts.withColumn("seen", F.when(hit, True).otherwise(F.col("seen")))
