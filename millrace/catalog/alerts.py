"""ALR: alerts as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.joins import SUBSCRIPTIONS, subscriptions
from millrace.catalog.registry import query
from millrace.operators import alerts


@query(
    "alr_01_spike_events",
    """SELECT 'price_spike' AS event_type, company_id, factory_id, '{"date":"' || date || '","is_price_spike":'
       || is_price_spike || '}' AS payload FROM mkt_c WHERE is_price_spike = 1""",
)
def _(f):
    spikes = f.market_clean.filter("is_price_spike = 1")
    return alerts.alert_events(spikes, "price_spike", ["date", "is_price_spike"])


@query(
    "alr_02_tenant_summaries",
    """SELECT company_id, factory_id, 'low_efficiency' AS event_type, count(*) AS row_count
       FROM prod_c WHERE is_underperforming = 1 GROUP BY company_id, factory_id""",
)
def _(f):
    low = f.production_flagged.filter("is_underperforming = 1")
    return alerts.tenant_summaries(low, "low_efficiency", ["facility", "production_line", "date", "efficiency_pct"]).select(
        "company_id", "factory_id", "event_type", "row_count"
    )


@query(
    "alr_03_market_alert",
    f"""SELECT t.company_id, t.factory_id, d.detail_json, d.row_count FROM
        (SELECT DISTINCT company_id, factory_id FROM {SUBSCRIPTIONS} AS s WHERE enabled) AS t,
        (SELECT '[' || string_agg(CASE WHEN rn <= 10 THEN '{{"date":"' || date || '","is_price_spike":1}}' END, ','
                ORDER BY rn) || ']' AS detail_json, count(*) AS row_count
         FROM (SELECT date, row_number() OVER (ORDER BY date) AS rn FROM mkt_c WHERE is_price_spike = 1) AS x) AS d""",
)
def _(f):
    spikes = f.market_clean.filter("is_price_spike = 1")
    return alerts.market_alert(spikes, "price_spike", ["date", "is_price_spike"], ["date"], subscriptions(f)).select(
        "company_id", "factory_id", "detail_json", "row_count"
    )


@query(
    "alr_04_low_efficiency_lines",
    """SELECT company_id, factory_id, facility, production_line, line_type, avg_efficiency FROM line
       WHERE avg_efficiency < 70""",
    r4="avg_efficiency",
)
def _(f):
    return alerts.low_efficiency_lines(f.line_efficiency).select(
        "company_id", "factory_id", "facility", "production_line", "line_type", "avg_efficiency"
    )


@query(
    "alr_05_routing",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'market' WHEN 'click' THEN 'ops' ELSE 'management' END AS channel
       FROM events""",
)
def _(f):
    kind = (
        F.when(F.col("event_type") == "view", "price_spike")
        .when(F.col("event_type") == "click", "low_efficiency")
        .otherwise(F.col("event_type"))
    )
    return f.table("events").select("event_id", alerts.channel(kind).alias("channel"))
