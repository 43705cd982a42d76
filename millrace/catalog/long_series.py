"""WIN, AGG, SRC: frames along a long order, merged sketches, scans of a curve layout, uploads against indexed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.registry import query
from millrace.functions import series
from millrace.operators import quality, sketches
from millrace.plans.halo import over_long_series
from millrace.schemas import TENANT_KEYS
from millrace.session import scratch_path
from millrace.sinks import snapshots
from millrace.sources import keys

# Small against the tables, so that frames cross many borders.
BLOCK = 4096
_SERIES = "(PARTITION BY 1 ORDER BY date NULLS FIRST, batch_id NULLS FIRST, efficiency_pct NULLS FIRST{})"
_LAST = " ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


def _long(f, columns, before):
    rows = f.production.select("batch_id", "date", "efficiency_pct")
    return over_long_series(rows, ["date", "batch_id", "efficiency_pct"], columns, before, block_rows=BLOCK)


@query(
    "win_04_long_series_lags",
    "SELECT batch_id, date, efficiency_pct, " + ", ".join(
        f"lag(efficiency_pct, {n}) OVER {_SERIES.format('')} AS lag_{n}" for n in (1, 7, 14, 30)
    ) + " FROM prod",
    r4="efficiency_pct lag_1 lag_7 lag_14 lag_30",
)
def _(f):
    return _long(f, {f"lag_{n}": lambda over, n=n: series.previous("efficiency_pct", over, n) for n in (1, 7, 14, 30)}, 30)


@query(
    "win_05_long_series_means",
    "SELECT batch_id, date, " + ", ".join(
        f"avg(efficiency_pct) OVER {_SERIES.format(_LAST.format(n - 1))} AS mean_{n}" for n in (7, 14, 30)
    ) + " FROM prod",
    r4="mean_7 mean_14 mean_30",
)
def _(f):
    means = {f"mean_{n}": lambda over, n=n: series.moving_avg("efficiency_pct", over, n, None) for n in (7, 14, 30)}
    return _long(f, means, 29).drop("efficiency_pct")


@query(
    "win_06_long_series_deviations",
    f"SELECT batch_id, date, stddev_samp(efficiency_pct) OVER {_SERIES.format(_LAST.format(29))} AS std_30 FROM prod",
    r4="std_30",
)
def _(f):
    return _long(f, {"std_30": lambda over: series.rolling_std("efficiency_pct", over, 30, None)}, 29).drop("efficiency_pct")


def _sketched(f):
    """Sketches of tenant-days, written in two batches, the second with late rows of all days."""
    path = scratch_path(f.spark, "sketches")
    late = F.crc32(F.col("batch_id").cast("binary")) % 10 == 0
    for at, part in enumerate((~late, late)):
        states = sketches.sketch_states(f.production.filter(part), [*TENANT_KEYS, "date"], "efficiency_pct", "facility")
        if at == 0:
            snapshots.replace_all(states, path, TENANT_KEYS)
        else:
            snapshots.append_rows(states, path)
    return snapshots.read_snapshot(f.spark, path)


@query(
    "agg_10_sketched_distribution",
    "SELECT company_id, factory_id, mark, count(efficiency_pct) AS n_values, TRUE AS within_bound FROM prod, "
    "(SELECT unnest(['p5', 'p25', 'p50', 'p75', 'p95']) AS mark) AS marks GROUP BY ALL",
)
def _(f):
    states = _sketched(f)
    found = sketches.distribution(states, TENANT_KEYS, quality.CENTILES)
    errors = sketches.rank_errors(f.production, TENANT_KEYS, "efficiency_pct", found, quality.CENTILES)
    return errors.join(found.select(*TENANT_KEYS, "n_values"), TENANT_KEYS).select(
        *TENANT_KEYS, "mark", "n_values", (F.col("rank_error") <= sketches.RANK_BOUND).alias("within_bound")
    )


@query(
    "agg_38_sketched_duplicates",
    "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_keys, TRUE AS within_bound FROM orders",
)
def _(f):
    states = sketches.sketch_states(f.table("orders"), ["o_orderdate"], "o_totalprice", "o_custkey")
    path = scratch_path(f.spark, "sketches")
    snapshots.replace_all(states, path, [])
    about = sketches.distinct_report(snapshots.read_snapshot(f.spark, path), [])
    exact = quality.duplicate_report(f.table("orders"), "o_custkey").select("distinct_keys").scalar()
    error = F.abs(F.col("distinct_keys") / exact - 1)
    return about.select("total_rows", exact.alias("distinct_keys"), (error <= sketches.DISTINCT_BOUND).alias("within_bound"))


_FROM, _TO = "1995-01-01", "1995-06-30"


@query(
    "src_02_curve_scan",
    f"""SELECT facility, count(*) AS n, sum(actual_tons) AS tons, min(date) AS first_day, max(date) AS last_day FROM prod
        WHERE company_id = 'ASIA' AND factory_id = 'ASIA_0' AND date BETWEEN DATE '{_FROM}' AND DATE '{_TO}' GROUP BY facility""",
    r4="tons",
)
def _(f):
    path = scratch_path(f.spark, "curve")
    rows = f.production.select(*TENANT_KEYS, "date", "facility", "batch_id", "actual_tons")
    snapshots.replace_all(rows, path, [*TENANT_KEYS, "date"], curve_files=64)
    mine = {"company_id": (TEST_TENANT.company_id,) * 2, "factory_id": (TEST_TENANT.factory_id,) * 2, "date": (_FROM, _TO)}
    return snapshots.read_ranges(f.spark, path, mine).groupBy("facility").agg(
        F.count(F.lit(1)).alias("n"), F.sum("actual_tons").alias("tons"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )


def _indexed_orders(f):
    """Raw orders of the first half of each year, indexed, then more files that the index does not know."""
    path = scratch_path(f.spark, "raw-orders")
    table, index = f"{path}/orders", f"{path}/orders-keys"
    half = F.month("order_date") <= 6
    f.orders.filter(half).write.partitionBy(*TENANT_KEYS).parquet(table)
    keys.index_files(f.spark, table, ["order_id"], index)
    f.orders.filter(half.isNull() | (F.month("order_date") > 11)).write.mode("append").partitionBy(*TENANT_KEYS).parquet(table)
    return table, index


@query(
    "src_06_indexed_upload",
    """SELECT order_id, 'ASIA' AS company_id, 'ASIA_0' AS factory_id, quantity_tons FROM ord AS n
       WHERE NOT EXISTS (SELECT 1 FROM ord AS e WHERE e.order_id = n.order_id AND e.company_id = 'ASIA' AND e.factory_id = 'ASIA_0'
                         AND (month(e.order_date) NOT BETWEEN 7 AND 11 OR e.order_date IS NULL))""",
)
def _(f):
    table, index = _indexed_orders(f)
    taken = keys.take_indexed(f.spark, f.orders, "orders", TEST_TENANT, f.places, table, index)
    return taken.select("order_id", *TENANT_KEYS, "quantity_tons")


@query(
    "snk_12_upload_ledger",
    "SELECT 'ASIA' AS company_id, 'ASIA_0' AS factory_id, 'orders' AS feed, count(*) AS n_rows, FALSE AS before, TRUE AS after FROM ord",
)
def _(f):
    ledger = scratch_path(f.spark, "ledger")
    before = keys.taken_before(f.spark, f.orders, "orders", TEST_TENANT, ledger)
    keys.note_taken(f.orders, "orders", TEST_TENANT, ledger)
    after = keys.taken_before(f.spark, f.orders.orderBy("order_id"), "orders", TEST_TENANT, ledger)
    noted = f.spark.read.parquet(ledger).drop("digest")
    return noted.withColumns({"before": F.lit(before), "after": F.lit(after)})
