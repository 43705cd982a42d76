import datetime
import random

import pytest
from pyspark.sql import Window, functions as F

from millrace.functions import series
from millrace.operators import quality, sketches
from millrace.plans.halo import over_long_series
from millrace.sinks import layout, snapshots

FRAMES = {
    "lag_5": lambda over: series.previous("v", over, 5),
    "mean_4": lambda over: series.moving_avg("v", over, 4, None),
    "ahead": lambda over: F.lead("v", 2).over(over),
    "around": lambda over: F.count("v").over(over.rowsBetween(-3, 2)),
}


@pytest.mark.parametrize("n, block", [(0, 3), (1, 3), (40, 1), (40, 3), (40, 7), (41, 40), (40, 1000)])
def test_frames_cross_borders(rows, collect, n, block):
    pick = random.Random(n)
    data = [(i % 3 or None, i, None if i % 7 == 3 else pick.randint(0, 99) * 1.0) for i in range(n)]
    df = rows(data, "day int, id int, v double").repartition(5)
    got = over_long_series(df, ["day", "id"], FRAMES, before=5, after=2, block_rows=block)
    plain = Window.orderBy("day", "id")
    want = df.withColumns({name: make(plain) for name, make in FRAMES.items()})
    assert got.columns == want.columns and collect(got, "id") == collect(want, "id")


def test_no_task_holds_more_than_its_block(spark):
    df = spark.range(5000).select(F.lit(1).alias("day"), "id", F.lit(1.0).alias("v"))  # all on one day
    held = over_long_series(df, ["day", "id"], {"held": lambda over: F.count("v").over(over.rowsBetween(-(10**6), 10**6))}, 29, 3, 100)
    assert held.agg(F.max("held")).first()[0] == 100 + 29 + 3
    with pytest.raises(ValueError, match="inner names"):
        over_long_series(df.withColumn("__no", F.lit(1)), ["id"], {}, 1)


@pytest.mark.parametrize("n", [2_000, 60_000])
def test_sketches_keep_their_bounds(spark, n):
    # a third of the rows in one group, a third of the values alike
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"),
        F.when(F.col("id") % 3 == 1, 5.0).when(F.col("id") % 50 == 0, float("nan")).when(F.col("id") % 49 != 0, F.xxhash64("id") % 10_000).alias("v"),
        (F.col("id") % (n // 4)).alias("k"),
    )
    early, late = (sketches.sketch_states(df.filter(c), ["g"], "v", "k") for c in ("id % 10 > 0", "id % 10 = 0"))
    states = early.unionByName(late)
    for by in (["g"], []):
        found = sketches.distribution(states, by, quality.CENTILES)
        errors = sketches.rank_errors(df, by, "v", found, quality.CENTILES)
        worst = errors.agg(F.max("rank_error"), F.count(F.lit(1))).first()
        assert worst[0] <= sketches.RANK_BOUND and worst[1] == 5 * found.count()
    whole = sketches.distinct_report(sketches.merged(states, ["g"]), []).first()
    assert whole.total_rows == n and abs(whole.distinct_keys / (n // 4) - 1) <= sketches.DISTINCT_BOUND
    assert whole.duplicates == whole.total_rows - whole.distinct_keys


def test_sketches_of_nothing(rows):
    df = rows([("A", None, None)], "g string, v double, k string")
    found = sketches.distribution(sketches.sketch_states(df, ["g"], "v", "k"), ["g"], quality.CENTILES).first()
    assert (found.n_rows, found.n_values, found.p50) == (1, 0, None)
    one = sketches.distinct_report(sketches.sketch_states(df, ["g"], "v", "k"), ["g"]).first()
    assert (one.total_rows, one.distinct_keys) == (1, 0)
    assert sketches.distribution(sketches.sketch_states(df.limit(0), ["g"], "v", "k"), ["g"], {"p50": 0.5}).collect() == []


ZONES = ["company_id", "factory_id", "date"]
FIRST = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def curve(spark, tmp_path_factory):
    """A year of eight tenants; every third row is of one of them."""
    path = str(tmp_path_factory.mktemp("curve") / "t")
    tenant = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 8)
    df = spark.range(24_000).select(
        F.concat(F.lit("C"), F.floor(tenant / 2).cast("string")).alias("company_id"),
        F.concat(F.lit("F"), tenant.cast("string")).alias("factory_id"),
        F.date_add(F.lit(FIRST), F.pmod(F.xxhash64("id"), F.lit(360)).cast("int")).alias("date"),
        "id",
    )
    df = df.withColumn("date", F.when(F.col("id") % 100 != 0, F.col("date")))
    snapshots.replace_all(df, path, ZONES, curve_files=64)
    return path, df


@pytest.mark.parametrize("ranges", [
    {"company_id": ("C2", "C2"), "factory_id": ("F5", "F5"), "date": ("2024-03-01", "2024-03-31")},
    {"date": (datetime.date(2024, 3, 1), datetime.date(2024, 3, 31))},
    {"factory_id": ("F5", "F5")},
    {"date": (None, "2024-01-20"), "id": (100, None)},
    {"date": ("2030-01-01", None)},
])
def test_ranges_open_few_files(spark, curve, ranges):
    path, df = curve
    got = snapshots.read_ranges(spark, path, ranges)
    keep = " AND ".join(
        f"{c} >= '{lo}'" if hi is None else f"{c} <= '{hi}'" if lo is None else f"{c} BETWEEN '{lo}' AND '{hi}'" for c, (lo, hi) in ranges.items()
    )
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in df.filter(keep).collect())
    at = snapshots.snapshot(spark, path)
    opened, files = len(got.inputFiles()), at.files(spark).count()
    assert files >= 32 and opened <= files * 0.5
    if len(ranges) == 3:
        assert opened <= files * 0.15


def test_curve_files_are_even(spark, curve):
    sizes = sorted(r.rows for r in snapshots.snapshot(spark, curve[0]).files(spark).collect())
    assert sum(sizes) == 24_000 and sizes[-1] <= 3 * 24_000 / 64


def test_a_hot_cell_is_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(8000).select(F.lit("A").alias("company_id"), F.lit(FIRST).alias("date"), "id")
    snapshots.replace_all(df, path, ["company_id", "date"], curve_files=8)
    sizes = [r.rows for r in snapshots.snapshot(spark, path).files(spark).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 2500
    assert snapshots.read_ranges(spark, path, {"date": (FIRST, FIRST)}).count() == 8000


def test_bits_are_interleaved(rows):
    got = rows([(0b101, 0b011)], "a long, b long").select(layout.interleaved([F.col("a"), F.col("b")], 3)).first()[0]
    assert got == 0b100111
