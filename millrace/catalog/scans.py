"""SRC: readers, checked by writing a table to the shared folder and scanning it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.registry import query
from millrace.session import scratch_path
from millrace.sinks.tables import write_partitioned
from millrace.sources import prices, tables, uploads
from millrace.streaming.sources import decode


@query(
    "src_01_csv_feed_scan",
    """SELECT order_id, order_date, customer_id, customer_type, product_type, quantity_tons, total_value_egp,
       delay_days, CAST(is_delayed AS BOOLEAN) AS is_delayed, status FROM ord""",
)
def _(f):
    cols = [
        "order_id", "order_date", "customer_id", "customer_type", "product_type", "quantity_tons", "total_value_egp",
        "delay_days", "is_delayed", "status",
    ]
    path = scratch_path(f.spark, "orders-csv")
    f.orders.select(*cols).withColumn("is_delayed", F.col("is_delayed").cast("boolean")).write.option(
        "header", True
    ).csv(path)
    return tables.read_feed(f.spark, path, "orders")


@query(
    "src_02_layer_scan",
    """SELECT batch_id, date, facility, shift, actual_tons, company_id, factory_id FROM prod
       WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0'""",
)
def _(f):
    root = scratch_path(f.spark, "layer")
    cols = ["batch_id", "date", "facility", "shift", "actual_tons", "company_id", "factory_id"]
    write_partitioned(f.production.select(*cols), f"{root}/production_clean", ["company_id", "factory_id", "facility"])
    return tables.read_layer(f.spark, root, "production_clean", "cleaning", TEST_TENANT).select(*cols)


@query(
    "src_05_json_decode",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS decoded_id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS delay_days FROM ev""",
)
def _(f):
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("k").cast("string").alias("delay_days")))
    # Every tenth payload is cut short, as a broken message would be.
    broken = F.when(F.col("event_id") % 10 == 0, F.lit('{"event_id": "')).otherwise(body)
    raw = f.events.select(F.col("event_id").alias("source_id"), broken.alias("value"))
    flat = decode(raw, "shipments", keep=("source_id",))
    return flat.select(F.col("source_id").alias("event_id"), F.col("event_id").alias("decoded_id"), "delay_days")


@query(
    "src_06_upload_rows",
    """SELECT order_id, CAST('ASIA' AS VARCHAR) AS company_id, CAST('ASIA_0' AS VARCHAR) AS factory_id, quantity_tons
       FROM ord AS n WHERE NOT EXISTS (SELECT 1 FROM ord AS e WHERE e.order_id = n.order_id AND e.company_id = 'ASIA'
       AND e.factory_id = 'ASIA_0')""",
)
def _(f):
    existing = f.orders.filter(TEST_TENANT.predicate())
    accepted = uploads.take_upload(f.orders, "orders", TEST_TENANT, f.places, existing)
    return accepted.select("order_id", "company_id", "factory_id", "quantity_tons")


@query(
    "src_07_price_history",
    """SELECT strftime(date, '%Y-%m-%d') AS "Date", steel_price_egypt_egp AS "Close",
       1.0 / steel_price_egypt_egp AS usd_egp_rate FROM mkt""",
    r4="Close usd_egp_rate",
)
def _(f):
    history = f.market.select(F.col("date").alias("Date"), F.col("steel_price_egypt_egp").alias("Close"))
    return prices.price_history(history, invert="Close")


@query(
    "src_07_price_range",
    """SELECT count(*) AS n_rows, min(steel_price_egypt_egp) AS min_value, max(steel_price_egypt_egp) AS max_value
       FROM mkt""",
    r4="min_value max_value",
)
def _(f):
    return prices.price_range(f.market, "steel_price_egypt_egp")


@query(
    "src_07_rate_map",
    "SELECT 'd' || event_id AS date, CASE WHEN event_type = 'view' THEN 0.0::DOUBLE ELSE value END AS usd_egp_rate FROM events",
)
def _(f):
    currency = F.when(F.col("event_type") == "view", "EUR").otherwise("EGP")
    day = F.concat(F.lit("d"), F.col("event_id").cast("string"))
    body = F.to_json(F.struct(F.create_map(day, F.create_map(currency, F.col("value"))).alias("rates")))
    return prices.explode_rates(f.events.select(body.alias("body")), "body")


@query(
    "src_08_market_scrub",
    """SELECT CASE WHEN event_id % 4 = 0 THEN DATE '2024-06-30' ELSE CAST(ts AS DATE) END AS date,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN value * 2 ELSE value END
           AS steel_price_egypt_egp,
       CASE WHEN k < 50 THEN NULL ELSE CAST(k AS DOUBLE) END AS iron_ore_price_usd, CAST(NULL AS DOUBLE) AS scrap_price_usd,
       CAST(NULL AS DOUBLE) AS coking_coal_price_usd, CAST(NULL AS DOUBLE) AS billet_price_usd,
       value AS usd_egp_rate FROM ev WHERE NOT (event_type = 'error' AND k < 50)""",
)
def _(f):
    e = f.events
    feed = e.select(
        F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") != "view", F.col("value").cast("string"))
        .alias("rebar_egp"),
        F.when(F.col("event_type") == "view", F.struct((F.col("value") * 2).alias("egp"))).alias("rebar"),
        F.when(F.col("k") >= 50, F.col("k").cast("string")).alias("iron_ore_usd"),
        F.struct(F.col("value").alias("usd_egp")).alias("fx"),
    )
    return prices.scrub_market(feed, today=F.lit("2024-06-30").cast("date"))

