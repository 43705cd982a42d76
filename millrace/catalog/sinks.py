"""SNK: merge rules as result tables, and writers checked by reading back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.registry import query
from millrace.catalog.tops import INBOX, inbox_rows
from millrace.operators import alerts, marts, quality
from millrace.schemas import LAYOUTS
from millrace.session import scratch_path
from millrace.sinks import merge, messages, tables
from millrace.streaming.runner import BatchSink
from millrace.tenancy import Tenant

_SLIM = ["company_id", "factory_id", "facility", "batch_id", "date", "actual_tons", "efficiency_pct"]
_COUNTS = """SELECT company_id, factory_id, facility, count(*) AS n, sum(actual_tons) AS tons FROM {rows}
    GROUP BY company_id, factory_id, facility"""


def _counts(df):
    return df.groupBy("company_id", "factory_id", "facility").agg(
        F.count(F.lit(1)).alias("n"), F.sum("actual_tons").alias("tons")
    )


@query("snk_01_raw_write", _COUNTS.format(rows="prod"))
def _(f):
    path = scratch_path(f.spark, "raw")
    tables.write_raw(f.production.select(*_SLIM), path, "production", Tenant())
    return _counts(f.spark.read.parquet(path).filter(F.col("loaded_at").isNotNull()))


@query("snk_02_partitioned_write", _COUNTS.format(rows="prod"))
def _(f):
    path = scratch_path(f.spark, "production")
    tables.write_partitioned(f.production.select(*_SLIM), path, LAYOUTS["production_clean"])
    return _counts(f.spark.read.parquet(path))


@query(
    "snk_03_tenant_refresh",
    _COUNTS.format(rows="(SELECT * FROM prod WHERE NOT (factory_id = 'ASIA_0' AND efficiency_pct > 50)) AS p"),
)
def _(f):
    path = scratch_path(f.spark, "production")
    rows = f.production.select(*_SLIM)
    # An older layout first: it must not survive beside the new one.
    rows.write.partitionBy("facility").parquet(path)
    tables.write_partitioned(rows, path, LAYOUTS["production_clean"])
    mine = rows.filter(TEST_TENANT.predicate()).filter("efficiency_pct <= 50")
    tables.write_partitioned(mine, path, LAYOUTS["production_clean"], TEST_TENANT)
    return _counts(f.spark.read.parquet(path))


@query(
    "snk_05_replace_tenants",
    """SELECT company_id, factory_id, batch_id, actual_tons FROM prod WHERE company_id <> 'ASIA'
       UNION ALL SELECT company_id, factory_id, batch_id, actual_tons * 2 FROM prod WHERE company_id = 'ASIA'
       AND shift = 'night'""",
)
def _(f):
    rows = f.production.select("company_id", "factory_id", "batch_id", "actual_tons", "shift")
    new = rows.filter("company_id = 'ASIA' AND shift = 'night'").withColumn("actual_tons", F.col("actual_tons") * 2)
    return merge.replace_tenants(rows.drop("shift"), new.drop("shift"))


_TARGET = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("is_low", T.IntegerType()),
        T.StructField("actual_tons", T.DoubleType()),
    ]
)


@query(
    "snk_06_align_to_target",
    """SELECT batch_id, CAST(year(date) AS INTEGER) AS year, date, CAST(efficiency_pct < 70 AS INTEGER) AS is_low, actual_tons
       FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY year(date), date,
             CAST(efficiency_pct < 70 AS INTEGER), actual_tons) AS rn FROM prod) AS x WHERE rn = 1""",
)
def _(f):
    rows = f.production.select("actual_tons", "batch_id", "date", (F.col("efficiency_pct") < 70).alias("is_low"), "shift")
    return merge.align(rows, _TARGET, ["batch_id"])


@query("snk_07_global_reload", "SELECT date, steel_price_egypt_egp FROM mkt", r4="steel_price_egypt_egp")
def _(f):
    path = scratch_path(f.spark, "prices")
    rows = f.market.select("date", "steel_price_egypt_egp", F.year("date").alias("year"))
    tables.reload_global(rows, path, ["year"])
    tables.reload_global(rows, path, ["year"])
    return f.spark.read.parquet(path).drop("year")


@query(
    "snk_08_prediction_replace",
    """SELECT company_id, factory_id, count(*) AS n FROM (
       SELECT company_id, factory_id FROM ord WHERE factory_id <> 'ASIA_0'
       UNION ALL SELECT 'ASIA', 'ASIA_0' FROM feat WHERE price_lag_1d IS NOT NULL) AS x GROUP BY company_id, factory_id""",
)
def _(f):
    target = f.orders.select("company_id", "factory_id", F.col("order_date").alias("target_date"))
    fresh = f.price_features.filter("price_lag_1d IS NOT NULL").select(
        F.lit("ASIA").alias("company_id"), F.lit("ASIA_0").alias("factory_id"), F.col("date").alias("target_date")
    )
    return merge.replace_tenant(target, fresh, TEST_TENANT).groupBy("company_id", "factory_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk_09_batch_append",
    "SELECT event_type, 'ASIA' AS company_id, 'ASIA_0' AS factory_id, count(*) AS n FROM events GROUP BY event_type",
)
def _(f):
    root = scratch_path(f.spark, "batches")
    sink = BatchSink(f"{root}/rows", f"{root}/dead", "events", TEST_TENANT)
    rows = f.table("events").select("event_id", "event_type")
    sink(rows.filter("event_type = 'view'"), 0)
    sink(rows.filter("event_type <> 'view'"), 1)
    sink(rows.filter("event_type <> 'view'"), 1)  # replay of a batch
    back = f.spark.read.parquet(f"{root}/rows")
    return back.groupBy("event_type", "company_id", "factory_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk_10_dead_letter",
    """SELECT event_id, 'streaming.events' AS "table", 'disk full' AS error FROM events""",
)
def _(f):
    root = scratch_path(f.spark, "dead")

    def refuse(_df, _batch_id):
        raise OSError("disk full")

    sink = BatchSink(f"{root}/rows", f"{root}/dead", "streaming.events", TEST_TENANT, write=refuse)
    sink(f.table("events").select("event_id", "event_type"), 0)
    back = f.spark.read.schema("ts string, table string, error string, record string").json(f"{root}/dead")
    return back.select(F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"), "table", "error")


@query(
    "snk_11_event_envelope",
    """SELECT delivery_governorate AS key, 'ORD-' || CASE WHEN rn < 1000000 THEN lpad(CAST(rn AS VARCHAR), 6, '0')
       ELSE CAST(rn AS VARCHAR) END AS event_id, 'orders' AS producer, CAST(floor((rn - 1) / 5) + 1 AS INTEGER) AS cycle,
       order_id FROM (SELECT *, row_number() OVER (ORDER BY order_date, order_id) AS rn FROM ord) AS x""",
)
def _(f):
    rows = f.orders.select("order_date", "order_id", "delivery_governorate", "total_value_egp")
    sent = messages.envelope(rows, "orders", order=["order_date", "order_id"], batch_size=5)
    body = F.from_json("value", "event_id string, event_timestamp string, producer string, cycle int, order_id string")
    return sent.select("key", body.alias("b")).select("key", "b.event_id", "b.producer", "b.cycle", "b.order_id")


_KEYED = "(SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS k, l_partkey, l_suppkey, l_extendedprice FROM lineitem{w})"


def _lines(f):
    return f.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"), "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )


@query(
    "snk_12_insert_ignore",
    f"""SELECT k, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY k
        ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM {_KEYED.format(w=" WHERE l_returnflag <> 'A'")} AS n)
        AS x WHERE rn = 1 AND k NOT IN (SELECT k FROM {_KEYED.format(w=" WHERE l_returnflag = 'A'")} AS e)""",
)
def _(f):
    lines = _lines(f)
    old = lines.filter("l_returnflag = 'A'").drop("l_returnflag")
    new = lines.filter("l_returnflag <> 'A'").drop("l_returnflag")
    return merge.insert_ignore(old, new, ["k"])


@query(
    "snk_12_insert_counts",
    f"""SELECT inserted, offered, offered - inserted AS skipped FROM (SELECT
        (SELECT count(DISTINCT k) FROM {_KEYED.format(w=" WHERE l_returnflag <> 'A'")} AS n
         WHERE k NOT IN (SELECT k FROM {_KEYED.format(w=" WHERE l_returnflag = 'A'")} AS e)) AS inserted,
        (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'A') AS offered) AS c""",
)
def _(f):
    lines = _lines(f)
    old = lines.filter("l_returnflag = 'A'").drop("l_returnflag")
    new = lines.filter("l_returnflag <> 'A'").drop("l_returnflag")
    return merge.insert_counts(new, merge.insert_ignore(old, new, ["k"]))


_UPSERT = """SELECT k, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY k
    ORDER BY src, l_partkey, l_suppkey, l_extendedprice) AS rn FROM (SELECT k, l_partkey, l_suppkey, l_extendedprice, src
    FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS k, l_partkey, l_suppkey, l_extendedprice,
    CASE WHEN l_returnflag = 'A' THEN {old} ELSE {new} END AS src FROM lineitem) AS a) AS b) AS x WHERE rn = 1"""


def _upsert(f, update):
    lines = _lines(f)
    old, new = (lines.filter(c).drop("l_returnflag") for c in ("l_returnflag = 'A'", "l_returnflag <> 'A'"))
    return merge.upsert(old, new, ["k"], update=update)


@query("snk_13_upsert", _UPSERT.format(old=1, new=0))
def _(f):
    return _upsert(f, True)


@query("snk_13_insert_or_nothing", _UPSERT.format(old=0, new=1))
def _(f):
    return _upsert(f, False)


@query(
    "snk_14_rewrite_in_place",
    """SELECT company_id, factory_id, facility, count(*) AS n, sum(actual_tons + 1) AS tons FROM prod
       GROUP BY company_id, factory_id, facility""",
)
def _(f):
    path = scratch_path(f.spark, "production")
    tables.write_partitioned(f.production.select(*_SLIM), path, LAYOUTS["production_clean"])
    changed = f.spark.read.parquet(path).withColumn("actual_tons", F.col("actual_tons") + 1)
    tables.rewrite_in_place(changed, path, LAYOUTS["production_clean"])
    return _counts(f.spark.read.parquet(path))


@query(
    "snk_15_corrected_line_mart",
    """SELECT company_id, factory_id, facility, count(*) AS n, sum(total_output_tons) AS tons FROM line
       GROUP BY company_id, factory_id, facility""",
)
def _(f):
    path = scratch_path(f.spark, "lines")
    fixed = quality.repair_production(f.production)
    tables.write_partitioned(marts.line_efficiency(fixed, "waste_tons"), path, LAYOUTS["production_efficiency"])
    back = f.spark.read.parquet(path)
    return back.groupBy("company_id", "factory_id", "facility").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_output_tons").alias("tons")
    )


@query(
    "snk_16_alert_rows",
    """SELECT company_id, factory_id, 'low_efficiency' AS event_type, 'Low Production Efficiency' AS title,
       count(*) AS row_count, FALSE AS email_sent,
       '[' || string_agg(CASE WHEN rn <= 10 THEN '{"batch_id":"' || batch_id || '","shift":"' || shift || '"}' END, ','
                         ORDER BY rn) || ']' AS detail_json
       FROM (SELECT *, row_number() OVER (PARTITION BY company_id, factory_id ORDER BY batch_id, shift) AS rn
             FROM prod WHERE efficiency_pct < 70) AS x GROUP BY company_id, factory_id""",
)
def _(f):
    low = f.production.filter("efficiency_pct < 70")
    return alerts.tenant_summaries(low, "low_efficiency", ["batch_id", "shift"])


@query(
    "snk_17_mark_all_seen",
    f"""SELECT id, factory_id, CASE WHEN factory_id = 'ASIA_0' THEN TRUE ELSE seen END AS seen FROM {INBOX} AS i""",
)
def _(f):
    return alerts.mark_seen(inbox_rows(f), TEST_TENANT).select("id", "factory_id", "seen")


@query(
    "snk_17_mark_one_seen",
    f"""SELECT id, factory_id, CASE WHEN factory_id = 'ASIA_0' AND id = 2 THEN TRUE ELSE seen END AS seen
        FROM {INBOX} AS i""",
)
def _(f):
    return alerts.mark_seen(inbox_rows(f), TEST_TENANT, alert_id=2).select("id", "factory_id", "seen")
