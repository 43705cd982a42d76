"""The three MLlib jobs. Estimators, training and scoring are distributed; only metric rows and
feature importances, one value per feature, reach the driver."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import text
from millrace.ml import features, metrics
from millrace.ml.forests import fit_forest
from millrace.plans.numbering import frequency_index
from millrace.session import staged
from millrace.tenancy import Tenant, tag

SEED = 42

# Settings of the estimators.
PRICE_GBT = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": SEED}
PRICE_FOREST = {"numTrees": 100, "maxDepth": 8, "seed": SEED}
DEMAND_FOREST = {"numTrees": 150, "maxDepth": 10, "maxBins": 64, "seed": SEED}
DEMAND_GBT = {"maxIter": 80, "maxDepth": 10, "maxBins": 64, "stepSize": 0.1, "seed": SEED}
SUPPLIER_FOREST = {"numTrees": 100, "maxDepth": 6, "seed": SEED}
PRICE_TEST_DAYS = 60
DEMAND_TEST_DAYS = 28
#: Training rows of a task. Every task of a forest sends its statistics of all open nodes, so tasks of a few rows
#: each cost far more than their rows.
TASK_ROWS = 10_000
#: The same for forests of few nodes, whose statistics are small beside the rows.
DELIVERY_TASK_ROWS = 100_000


@dataclass(frozen=True)
class Fitted:
    """Models of one job by name, the test metrics of each, and the name of the best."""

    models: dict[str, PipelineModel]
    scores: dict[str, dict]
    scored: dict[str, DataFrame]
    feature_names: list[str]

    @property
    def best(self) -> str:
        """Lowest RMSE (ML-03); the first named wins a tie."""
        return min(self.scores, key=lambda name: self.scores[name]["rmse"])

    @property
    def predictions(self) -> DataFrame:
        return self.scored[self.best]


def standardised(inputs: list[str]) -> list:
    """Assemble and standardise (ML-01)."""
    return [
        VectorAssembler(inputCols=inputs, outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def encoded_demand() -> list:
    """Index and one-hot encode product and region, then assemble (ML-04)."""
    names = {"product_type": "product", "region": "region"}
    return [
        StringIndexer(
            inputCols=list(names), outputCols=[f"{n}_idx" for n in names.values()], handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=[f"{n}_idx" for n in names.values()], outputCols=[f"{n}_vec" for n in names.values()]),
        VectorAssembler(
            inputCols=[*features.DEMAND_NUMERIC, *[f"{n}_vec" for n in names.values()]], outputCol="features"
        ),
    ]


def _metrics_row(df: DataFrame, actual: str, predicted: str) -> dict:
    return metrics.regression_metrics(df, actual, predicted).first().asDict()


def dealt(df: DataFrame, keys: list[str], task_rows: int = TASK_ROWS, ties: list[str] | None = None) -> DataFrame:
    """The rows in as many partitions as their number asks for, each in order, so a seeded fit repeats. Rows of equal keys
    are ordered by ``ties``."""
    parts = max(1, -(-df.count() // task_rows))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, *(ties or []))


def _fit_and_score(
    stages: list, estimators: dict, train: DataFrame, test: DataFrame, keys: list[str], finish, actual: str, predicted: str, names: list[str]
) -> Fitted:
    """The feature stages are fitted once and shared by the estimators; ``keys`` tell the rows apart."""
    prepare = Pipeline(stages=stages).fit(train)
    ready, held = dealt(prepare.transform(train), keys).persist(), prepare.transform(test)
    models, scores, scored = {}, {}, {}
    for name, estimator in estimators.items():
        model = estimator.fit(ready)
        models[name] = PipelineModel([*prepare.stages, model])
        scored[name] = finish(model.transform(held))
        scores[name] = _metrics_row(scored[name], actual, predicted)
    ready.unpersist()
    return Fitted(models, scores, scored, names)


def fit_price_models(
    price_features: DataFrame, gbt: dict = PRICE_GBT, forest: dict = PRICE_FOREST, test_days: int = PRICE_TEST_DAYS
) -> Fitted:
    """Predict the daily price step; the price is yesterday's plus the step (ML-02)."""
    rows = features.price_training_rows(price_features).persist()
    train, test = features.time_split(rows, "date", test_days)
    columns = {"featuresCol": "features", "labelCol": "price_delta"}
    return _fit_and_score(
        standardised(features.PRICE_FEATURES),
        {"GBT": GBTRegressor(**columns, **gbt), "RandomForest": RandomForestRegressor(**columns, **forest)},
        train,
        test,
        ["date"],
        lambda df: df.withColumn("pred_price", F.col("price_lag_1d") + F.col("prediction")),
        "steel_price_egp",
        "pred_price",
        features.PRICE_FEATURES,
    )


def fit_demand_models(
    demand: DataFrame, forest: dict = DEMAND_FOREST, gbt: dict = DEMAND_GBT, test_days: int = DEMAND_TEST_DAYS
) -> Fitted:
    """Predict weekly demand in log space (ML-05)."""
    rows = demand.persist()
    train, test = features.time_split(rows, "week_start", test_days)
    columns = {"featuresCol": "features", "labelCol": "log1p_demand"}
    return _fit_and_score(
        encoded_demand(),
        {"RandomForest": RandomForestRegressor(**columns, **forest), "GBT": GBTRegressor(**columns, **gbt)},
        train,
        test,
        ["week_start", "product_type", "region"],
        lambda df: df.withColumn("pred_demand", features.back_to_tons("prediction")),
        "weekly_demand_tons",
        "pred_demand",
        features.DEMAND_NUMERIC,
    )


def compare(scored: dict[str, DataFrame], actual: str, predicted: str) -> Fitted:
    """Predictions that need no fit, scored and compared as the models are (ML-02, ML-03, ML-05)."""
    return Fitted({}, {name: _metrics_row(df, actual, predicted) for name, df in scored.items()}, scored, [])


def price_baselines(price_features: DataFrame, test_days: int = PRICE_TEST_DAYS) -> Fitted:
    """The price of yesterday and of a week ago as predictions for the test days: what a model has to beat."""
    _train, test = features.time_split(features.price_training_rows(price_features), "date", test_days)
    past = {"Yesterday": "price_lag_1d", "LastWeek": "price_lag_7d"}
    return compare({name: test.withColumn("pred_price", F.col(c)) for name, c in past.items()}, "steel_price_egp", "pred_price")


def demand_baselines(demand: DataFrame, test_days: int = DEMAND_TEST_DAYS) -> Fitted:
    """Last week's demand and the mean of four weeks as predictions for the test weeks."""
    _train, test = features.time_split(demand, "week_start", test_days)
    lags = [F.col(f"demand_lag_{n}w") for n in (1, 2, 3, 4)]
    guesses = {"LastWeek": lags[0], "FourWeeks": (lags[0] + lags[1] + lags[2] + lags[3]) / 4}
    return compare({name: test.withColumn("pred_demand", g) for name, g in guesses.items()}, "weekly_demand_tons", "pred_demand")


@dataclass
class SupplierModels:
    """Risk label classifier and risk points regressor on one split (ML-06, ML-08). Each is trained when first asked for."""

    prepare: PipelineModel
    train: DataFrame
    deliveries: DataFrame
    test: DataFrame
    forest: dict

    def _fit(self, estimator: type, label: str) -> PipelineModel:
        """Rows are dealt once, narrow; every pass reads that shuffle and makes their features anew."""
        values = [*features.SUPPLIER_FEATURES, label]
        rows = dealt(self.train.select("purchase_id", *values), ["purchase_id"], DELIVERY_TASK_ROWS, ties=values)
        ready = self.prepare.transform(rows).select("features", label)
        model = fit_forest(estimator(featuresCol="features", labelCol=label, **self.forest), ready, self.train)
        return PipelineModel([*self.prepare.stages, model])

    @cached_property
    def classifier(self) -> PipelineModel:
        return self._fit(RandomForestClassifier, "risk_label")

    @cached_property
    def regressor(self) -> PipelineModel:
        return self._fit(RandomForestRegressor, "risk_points")


SUPPLIER_INPUTS = [
    "purchase_id", "supplier_name", "material_type", "origin_country", "quality_grade", "on_time", "days_late", "lead_time_days",
    "quantity_tons", "price_per_ton_usd", "ocean_freight_usd_per_ton", "total_landed_cost_usd", "supplier_reliability",
]


def supplier_rows(purchases: DataFrame) -> DataFrame:
    """Deliveries with risk points and label, and an index per name column. The purchases are read once."""
    rows = features.delivery_risk(staged(purchases.select(*SUPPLIER_INPUTS), "purchases", tidy=True))
    for label, name in [("supplier_name", "supplier_idx"), ("material_type", "material_idx"), ("origin_country", "country_idx")]:
        rows = frequency_index(rows, label, name)
    return rows


def fit_supplier_models(purchases: DataFrame, forest: dict = SUPPLIER_FOREST) -> SupplierModels:
    """The split and its features. No rows are cached: what the trees keep of them has the memory."""
    rows = supplier_rows(purchases)
    train, test = features.hash_split(rows, "purchase_id", seed=SEED)
    prepare = Pipeline(stages=standardised(features.SUPPLIER_FEATURES)).fit(train)
    return SupplierModels(prepare, train, rows, test, forest)


def scores_table(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Metrics of every model of a job, one row each; ``df`` only lends its session."""
    names = ["rmse", "mae", "mape", "mape_true", "r2"]
    rows = [(m, *[float(s[n]) for n in names], m == fitted.best) for m, s in fitted.scores.items()]
    return df.sparkSession.createDataFrame(rows, "model string, " + ", ".join(f"{n} double" for n in names) + ", is_best boolean")


def importances(df: DataFrame, model: PipelineModel, names: list[str]) -> DataFrame:
    """Ranked feature importances (ML-09): one value per feature, known by the model."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


# -- prediction tables (ML-10) ----------------------------------------------------------------


def price_predictions(scored: DataFrame, model: str, tenant: Tenant, run_date: Column | None = None) -> DataFrame:
    today = F.current_date() if run_date is None else run_date
    out = scored.select(
        today.alias("prediction_date"),
        F.col("date").alias("target_date"),
        F.round("pred_price", 2).alias("predicted_price_egp"),
        F.round("steel_price_egp", 2).alias("actual_price_egp"),
        text.model_tag("v1.1", model, "_delta").alias("model_version"),
        *features.confidence_band("pred_price"),
        F.current_timestamp().alias("created_at"),
    )
    return tag(out, tenant.company_id, tenant.factory_id)


def demand_forecasts(scored: DataFrame, model: str, tenant: Tenant, run_date: Column | None = None) -> DataFrame:
    """``governorate`` holds the region, as the published table does."""
    today = F.current_date() if run_date is None else run_date
    out = scored.select(
        today.alias("forecast_date"),
        F.col("week_start").alias("target_date"),
        F.col("region").alias("governorate"),
        "product_type",
        F.round("pred_demand", 2).alias("predicted_quantity_tons"),
        F.round("weekly_demand_tons", 2).alias("actual_quantity_tons"),
        text.model_tag("v1.1", model, "_log").alias("model_version"),
        F.current_timestamp().alias("created_at"),
    )
    return tag(out, tenant.company_id, tenant.factory_id)


def supplier_risk_scores(models: SupplierModels, tenant: Tenant, run_date: Column | None = None) -> DataFrame:
    """All deliveries scored, rolled up per supplier and graded."""
    today = F.current_date() if run_date is None else run_date
    graded = metrics.risk_levels(metrics.supplier_rollup(models.regressor.transform(models.deliveries)))
    out = graded.select(
        today.alias("scored_date"),
        "supplier_name",
        F.round("avg_risk_score", 2).alias("risk_score"),
        "risk_level",
        "on_time_factor",
        "quality_factor",
        "price_factor",
        text.model_tag("v1.0", "RandomForest").alias("model_version"),
        F.current_timestamp().alias("created_at"),
    )
    return tag(out, tenant.company_id, tenant.factory_id)
