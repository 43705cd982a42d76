"""Metrics against MLlib, determinism, and bounds; small settings keep the fits short."""

import threading

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT, Feeds
from millrace.ml import features, forests, metrics, models
from millrace.plans.numbering import frequency_index
from millrace.session import CLEANUP_CONF, staged


@pytest.fixture(scope="module")
def feeds(spark, sf_dir):
    return Feeds(spark, sf_dir)


def test_classification_metrics_match_mllib(spark):
    pairs = [(0, 0)] * 40 + [(0, 1)] * 5 + [(1, 1)] * 20 + [(1, 2)] * 4 + [(2, 2)] * 9 + [(2, 0)] * 3
    df = spark.createDataFrame([(float(t), float(p)) for t, p in pairs], "label double, prediction double")
    ours = metrics.classification_metrics(df, "label", "prediction").first()
    for name, column in [("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")]:
        assert MulticlassClassificationEvaluator(metricName=name).setLabelCol("label").evaluate(df) == pytest.approx(ours[column])
    for name, column in [("precisionByLabel", "focus_precision"), ("recallByLabel", "focus_recall")]:
        assert MulticlassClassificationEvaluator(metricName=name, metricLabel=2.0).evaluate(df) == pytest.approx(ours[column])


def test_label_never_predicted(spark):
    df = spark.createDataFrame([(2.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    row = metrics.classification_metrics(df, "label", "prediction").first()
    assert (row.focus_precision, row.focus_recall, row.accuracy) == (0.0, 0.0, 0.5)


def test_regression_metrics_match_mllib(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (0.0, 1.0)], "label double, prediction double")
    ours = metrics.regression_metrics(df, "label", "prediction").first()
    for name in ("rmse", "mae", "r2"):
        assert RegressionEvaluator(metricName=name).evaluate(df) == pytest.approx(ours[name])
    assert ours.mape == pytest.approx(ours.mae / 1.75 * 100)


def test_risk_points(rows):
    df = rows(
        [("m", "A", 1, 100.0, 0), ("m", "C", 0, 300.0, 8), ("m", "C", 0, 100.0, 2), ("m", None, 1, 100.0, -3)],
        "material_type string, quality_grade string, on_time int, price_per_ton_usd double, days_late int",
    )
    got = features.delivery_risk(df).orderBy("days_late").collect()
    assert [(r.days_late, r.quality_num, r.risk_points, r.risk_label) for r in got] == [
        (-3, 2.5, -6, 0), (0, 4.0, 0, 0), (2, 2.0, 74, 2), (8, 2.0, 100, 2),
    ]


def test_risk_levels(rows):
    df = rows([(f"s{i}", float(i)) for i in range(1, 11)], "supplier_name string, avg_risk_score double")
    got = {r.supplier_name: r.risk_level for r in metrics.risk_levels(df).collect()}
    assert [got[f"s{i}"] for i in (1, 3, 4, 6, 7, 10)] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_risk_levels_of_a_count_whose_share_is_whole(spark):
    """0.67 of 1500 is 1005, though a little more as a double."""
    df = spark.range(1, 1501).select(F.col("id").cast("string").alias("supplier_name"), F.col("id").cast("double").alias("avg_risk_score"))
    high = metrics.risk_levels(df).filter("risk_level = 'HIGH'").agg(F.min("avg_risk_score"), F.count("*")).first()
    assert tuple(high) == (1005.0, 496)


def test_hash_split_is_stable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    train, test = features.hash_split(df, "k")
    again, _ = features.hash_split(df.repartition(13), "k")
    assert train.count() + test.count() == 5000 and 0.77 < train.count() / 5000 < 0.83
    assert train.exceptAll(again).isEmpty()


def test_time_split(rows):
    df = rows([("2024-01-01",), ("2024-02-01",), ("2024-03-01",)], "d string").select(F.to_date("d").alias("d"))
    train, test = features.time_split(df, "d", 29)
    assert (train.count(), test.count()) == (2, 1)


def test_price_models(feeds):
    small = {"gbt": {**models.PRICE_GBT, "maxIter": 3}, "forest": {**models.PRICE_FOREST, "numTrees": 5}}
    one = models.fit_price_models(feeds.price_features, **small)
    two = models.fit_price_models(feeds.price_features, **small)
    assert one.scores == two.scores  # seeded
    assert one.best == min(one.scores, key=lambda n: one.scores[n]["rmse"])
    table = models.price_predictions(one.predictions, one.best, TEST_TENANT)
    row = table.first()
    assert row.confidence_lower < row.predicted_price_egp < row.confidence_upper
    assert row.model_version == f"v1.1_{one.best}_delta" and row.factory_id == TEST_TENANT.factory_id
    assert models.importances(feeds.market, one.models["GBT"], features.PRICE_FEATURES).count() == 23


def test_demand_models(feeds):
    demand = features.demand_features(feeds.orders_regional, feeds.market)
    got = models.fit_demand_models(demand, forest={**models.DEMAND_FOREST, "numTrees": 5, "maxDepth": 4},
                                   gbt={**models.DEMAND_GBT, "maxIter": 2, "maxDepth": 3})
    assert models.demand_forecasts(got.predictions, got.best, TEST_TENANT).filter("predicted_quantity_tons < 0").isEmpty()
    scores = models.scores_table(feeds.market, got)
    assert scores.filter("is_best").count() == 1


def test_supplier_models(feeds):
    fitted = models.fit_supplier_models(feeds.purchases_timed, {"numTrees": 10, "maxDepth": 5, "seed": 42})
    quality = metrics.classification_metrics(fitted.classifier.transform(fitted.test), "risk_label", "prediction").first()
    assert quality.accuracy > 0.8
    scores = models.supplier_risk_scores(fitted, TEST_TENANT)
    assert scores.count() == feeds.purchases.select("supplier_name").distinct().count()
    assert {r.risk_level for r in scores.collect()} == {"LOW", "MEDIUM", "HIGH"}


def test_training_rows_are_dealt_by_their_number(spark):
    wide = spark.range(50).select("id", (F.col("id") * 2).alias("v")).repartition(40)
    got = models.dealt(wide, ["id"])
    assert got.rdd.getNumPartitions() == 1 and got.collect() == sorted(got.collect(), key=lambda r: r.id)
    assert models.dealt(wide, ["id"], 10).rdd.getNumPartitions() == 5 and got.exceptAll(wide).isEmpty()


def test_only_the_model_asked_for_is_trained(feeds):
    fitted = models.fit_supplier_models(feeds.purchases_timed, {"numTrees": 2, "maxDepth": 2, "seed": 42})
    assert fitted.regressor.stages[-1].getNumTrees == 2 and fitted.regressor is fitted.regressor
    assert "classifier" not in vars(fitted)


def test_few_labels_are_broadcast_to_the_rows(spark):
    rows = spark.range(0, 1000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("name"), F.concat(F.lit("k"), F.col("id") % 3).alias("kind"), F.col("id").alias("v"))
    for df in (frequency_index(rows, "name", "i"), features.above_group_mean(rows, "v", "kind", "above")):
        assert "BroadcastHashJoin" in df._jdf.queryExecution().sparkPlan().toString()


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_rollup_hashes_its_rows(feeds):
    plan = plan_of(metrics.supplier_rollup(features.delivery_risk(feeds.deliveries), prediction="risk_points"))
    of_rows = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in of_rows and "supplier_name" in of_rows


def test_lines_of_orders_are_not_sorted_and_joined_once(feeds):
    assert "SortMergeJoin" not in plan_of(feeds.line_days) and "ShuffledHashJoin" in plan_of(feeds.line_days)
    assert "lineitem.parquet" not in plan_of(features.delivery_risk(feeds.deliveries))


def points(spark, n):
    """Rows with features and a label, in five partitions."""
    made = spark.range(n).select("id", F.rand(1).alias("a"), (F.rand(2) * 30).cast("int").alias("b"), F.randn(3).alias("c"))
    label = F.when(F.col("a") + F.col("c") > 1, 2).when(F.col("b") > 12, 1).otherwise(0)
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(made.withColumn("label", label))
    return rows.repartition(5, "id").sortWithinPartitions("id").select("features", "label")


@pytest.mark.parametrize("kind", [RandomForestClassifier, RandomForestRegressor])
def test_forest_is_that_of_mllib_in_any_number_of_tasks(spark, monkeypatch, kind):
    rows, forest = points(spark, 12_000), kind(numTrees=6, maxDepth=4, seed=42)
    monkeypatch.setattr(forests, "PASS_TASKS", 0)
    monkeypatch.setattr(forests, "PASS_PARTITIONS", 2)
    assert forests.pass_tasks(5, 4) == 3
    want, got = forest.fit(rows), forests.fit_forest(forest, rows, rows)
    assert got.toDebugString == want.toDebugString and got.featureImportances == want.featureImportances
    assert type(got) is type(want) and got.extractParamMap() == want.extractParamMap()
    assert got.transform(rows).select("prediction").collect() == want.transform(rows).select("prediction").collect()


def test_forest_of_weighted_rows_is_refused(spark):
    rows = points(spark, 10).withColumn("w", F.lit(2.0))
    with pytest.raises(ValueError):
        forests.fit_forest(RandomForestRegressor(weightCol="w"), rows, rows)


def test_tasks_of_a_pass():
    assert [forests.pass_tasks(n, 8) for n in (1, 29, 288, 1728)] == [1, 29, 32, 173]


def test_training_keeps_no_rows_on_disk(spark, feeds):
    fitted = models.fit_supplier_models(feeds.purchases_timed, {"numTrees": 20, "maxDepth": 6, "seed": 42})
    held = lambda: dict(spark.sparkContext._jsc.getPersistentRDDs())
    before, done, seen = set(held()), threading.Event(), {}

    def watch():
        while not done.wait(0.02):
            seen.update({n: rdd.getStorageLevel().useDisk() for n, rdd in held().items() if n not in before})

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert fitted.classifier.stages[-1].getNumTrees == 20
    finally:
        done.set()
        watcher.join()
    assert seen and not any(seen.values())
    assert set(held()) <= before


def test_rows_of_one_key_are_dealt_in_one_order(spark):
    rows = spark.range(600).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(None).cast("int").alias("n"))
    ways = [models.dealt(rows.repartition(n, "v"), ["k"], 100, ties=["v", "n"]).rdd.glom().collect() for n in (1, 7)]
    assert ways[0] == ways[1] and len(ways[0]) == 6 and sum(map(len, ways[0])) == 600


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {name for name in blocks.split() if name.startswith("shuffle_")}


def test_tidy_staging_leaves_no_shuffle(spark):
    left = spark.range(5000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v")).withColumn("v", F.when(F.col("v") > 9, F.col("v")))
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).hint("shuffle_hash")
    before = shuffle_files(spark)
    got = staged(left.join(right, "k"), "tidy", tidy=True)
    assert shuffle_files(spark) <= before and spark.conf.get(CLEANUP_CONF) == "false"
    assert got.count() == 5000 and got.exceptAll(left.join(right, "k")).isEmpty()
