"""ML: feature tables (checked against SQL) and models (checked for rows)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.catalog.feeds import TEST_TENANT
from millrace.catalog.feeds_sql import rounded
from millrace.catalog.registry import query
from millrace.ml import features, metrics, models
from millrace.plans.numbering import frequency_index

_FITTED: dict = {}


def fitted(f, job: str):
    """Models trained once per session and data folder, shared by the queries that look at them."""
    key = (f.spark.sparkContext.applicationId, f.sf_dir, job)
    if key not in _FITTED:
        _FITTED[key] = {
            "price": lambda: models.fit_price_models(f.price_features),
            "demand": lambda: models.fit_demand_models(features.demand_features(f.orders_regional, f.market)),
            "supplier": lambda: models.fit_supplier_models(f.purchases_timed),
        }[job]()
    return _FITTED[key]


_ROWS = "(SELECT * FROM feat WHERE price_lag_30d IS NOT NULL AND price_volatility_7d IS NOT NULL)"
_SHOWN = ["usd_egp_rate", "price_lag_1d", "moving_avg_7d", "day_of_week"]


@query(
    "ml_01_standardised_price_features",
    "SELECT date, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z_{c}" for c in _SHOWN)
    + f" FROM {_ROWS} AS r",
    r4=" ".join(f"z_{c}" for c in _SHOWN),
)
def _(f):
    rows = features.price_training_rows(f.price_features)
    ready = Pipeline(stages=models.standardised(features.PRICE_FEATURES)).fit(rows).transform(rows)
    values = ready.select("date", vector_to_array("features").alias("v"))
    return values.select("date", *[F.col("v")[features.PRICE_FEATURES.index(c)].alias(f"z_{c}") for c in _SHOWN])


def _test_rows(rows: str, day: str, days: int) -> str:
    return f"(SELECT * FROM {rows} AS t WHERE {day} > (SELECT max({day}) - {days} FROM {rows} AS u))"


def _scores_sql(rows: str, actual: str, guesses: dict[str, str]) -> str:
    """Metrics of each guess; the mean is taken by itself, as the sum of squares around it needs it."""
    one = """SELECT '{name}' AS model, sqrt(avg((p - a) * (p - a))) AS rmse, avg(abs(p - a)) AS mae, avg(abs(p - a)) / avg(a) * 100 AS mape,
        avg(abs((p - a) / nullif(a, 0))) * 100 AS mape_true, 1 - sum((p - a) * (p - a)) / sum((a - m) * (a - m)) AS r2
        FROM (SELECT {guess} AS p, {actual} AS a, avg({actual}) OVER () AS m FROM {rows} AS r) AS s"""
    each = " UNION ALL ".join(one.format(name=n, guess=g, actual=actual, rows=rows) for n, g in guesses.items())
    return f"SELECT *, rmse = min(rmse) OVER () AS is_best FROM ({each}) AS e"


_SCORES = "rmse mae mape mape_true r2"
_PRICE_TEST = _test_rows(_ROWS, "date", 60)
_PRICE_SCORES = _scores_sql(_PRICE_TEST, "steel_price_egp", {"Yesterday": "price_lag_1d", "LastWeek": "price_lag_7d"})
_DEMAND_SCORES = _scores_sql(
    _test_rows("dem", "week_start", 28), "weekly_demand_tons",
    {"LastWeek": "demand_lag_1w", "FourWeeks": "(demand_lag_1w + demand_lag_2w + demand_lag_3w + demand_lag_4w) / 4"},
)


@query("ml_02_price_baselines", _PRICE_SCORES, r4=_SCORES)
def _(f):
    return models.scores_table(f.market, models.price_baselines(f.price_features))


@query("ml_03_best_price_baseline", f"SELECT * FROM ({_PRICE_SCORES}) AS b WHERE is_best", r4=_SCORES)
def _(f):
    return models.scores_table(f.market, models.price_baselines(f.price_features)).filter("is_best")


@query("ml_05_demand_baselines", _DEMAND_SCORES, r4=_SCORES)
def _(f):
    return models.scores_table(f.market, models.demand_baselines(features.demand_features(f.orders_regional, f.market)))


@query(
    "ml_10_baseline_prices",
    f"""SELECT DATE '2025-01-01' AS prediction_date, date AS target_date, {rounded('p', 2)} AS predicted_price_egp,
        {rounded('steel_price_egp', 2)} AS actual_price_egp, 'v1.1_' || best || '_delta' AS model_version,
        {rounded('p * 0.95::DOUBLE', 2)} AS confidence_lower, {rounded('p * 1.05::DOUBLE', 2)} AS confidence_upper,
        'ASIA' AS company_id, 'ASIA_0' AS factory_id
        FROM (SELECT *, CASE best WHEN 'Yesterday' THEN price_lag_1d ELSE price_lag_7d END AS p FROM {_PRICE_TEST} AS r,
              (SELECT model AS best FROM ({_PRICE_SCORES}) AS b WHERE is_best) AS w) AS x""",
)
def _(f):
    found = models.price_baselines(f.price_features)
    day = F.lit("2025-01-01").cast("date")
    return models.price_predictions(found.predictions, found.best, TEST_TENANT, day).drop("created_at")


@query("ml_02_price_models")
def _(f):
    return models.scores_table(f.market, fitted(f, "price"))


@query("ml_03_best_price_model")
def _(f):
    return models.scores_table(f.market, fitted(f, "price")).filter("is_best")


@query(
    "ml_04_demand_encoding",
    """SELECT week_start, product_type, region, CAST(p AS DOUBLE) AS product_idx, CAST(r AS DOUBLE) AS region_idx,
       CAST(1 AS DOUBLE) AS product_slot, CAST(1 AS DOUBLE) AS region_slot FROM dem
       JOIN (SELECT product_type, row_number() OVER (ORDER BY count(*) DESC, product_type) - 1 AS p FROM dem GROUP BY 1)
            AS a USING (product_type)
       JOIN (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS r FROM dem GROUP BY 1)
            AS b USING (region)""",
)
def _(f):
    rows = features.demand_features(f.orders_regional, f.market)
    ready = Pipeline(stages=models.encoded_demand()).fit(rows).transform(rows)
    slot = lambda vec, idx: F.element_at(vector_to_array(vec), F.col(idx).cast("int") + 1)
    return ready.select(
        "week_start", "product_type", "region", "product_idx", "region_idx",
        slot("product_vec", "product_idx").alias("product_slot"), slot("region_vec", "region_idx").alias("region_slot"),
    )


@query("ml_05_demand_models")
def _(f):
    return models.scores_table(f.market, fitted(f, "demand"))


@query(
    "ml_06_supplier_index",
    """SELECT purchase_id, supplier_name, CAST(i AS DOUBLE) AS supplier_idx FROM purch
       JOIN (SELECT supplier_name, row_number() OVER (ORDER BY count(*) DESC, supplier_name) - 1 AS i FROM purch
             GROUP BY 1) AS a USING (supplier_name)""",
)
def _(f):
    return frequency_index(f.purchases.select("purchase_id", "supplier_name"), "supplier_name", "supplier_idx")


@query("ml_06_rule_classes", "SELECT risk_label, CASE WHEN is_late = 1 AND is_expensive = 1 THEN 2 WHEN is_late = 1 THEN 1 ELSE 0 END AS prediction, count(*) AS n_rows FROM risk GROUP BY 1, 2")
def _(f):
    return metrics.label_counts(_guessed(f).withColumnRenamed("guess", "prediction"), "risk_label", "prediction")


@query("ml_06_supplier_risk_classes")
def _(f):
    m = fitted(f, "supplier")
    return metrics.label_counts(m.classifier.transform(m.test), "risk_label", "prediction")


def _guessed(f):
    guess = F.when((F.col("is_late") == 1) & (F.col("is_expensive") == 1), 2).when(F.col("is_late") == 1, 1).otherwise(0)
    return features.delivery_risk(f.purchases_timed).withColumn("guess", guess)


# Two rule-based guesses stand in for predictions, so that the metrics can be checked exactly.
_GUESS = "CASE WHEN is_late = 1 AND is_expensive = 1 THEN 2 WHEN is_late = 1 THEN 1 ELSE 0 END"


@query(
    "ml_07_classification_metrics",
    f"""SELECT sum(tp) / sum(actual) AS accuracy, sum(f1 * actual) / sum(actual) AS f1,
        sum(pr * actual) / sum(actual) AS weighted_precision, sum(rc * actual) / sum(actual) AS weighted_recall,
        coalesce(max(pr) FILTER (c = 2), 0) AS focus_precision, coalesce(max(rc) FILTER (c = 2), 0) AS focus_recall
        FROM (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1
              FROM (SELECT c, tp, actual, coalesce(tp / nullif(claimed, 0), 0.0) AS pr,
                    coalesce(tp / nullif(actual, 0), 0.0) AS rc
                    FROM (SELECT c, CAST((SELECT count(*) FROM risk WHERE risk_label = c AND {_GUESS} = c) AS DOUBLE) AS tp,
                          CAST((SELECT count(*) FROM risk WHERE risk_label = c) AS DOUBLE) AS actual,
                          CAST((SELECT count(*) FROM risk WHERE {_GUESS} = c) AS DOUBLE) AS claimed
                          FROM (SELECT unnest([0, 1, 2]) AS c) AS k) AS x) AS y) AS z""",
    r4="accuracy f1 weighted_precision weighted_recall focus_precision focus_recall",
)
def _(f):
    guess = F.when((F.col("is_late") == 1) & (F.col("is_expensive") == 1), 2).when(F.col("is_late") == 1, 1).otherwise(0)
    rows = features.delivery_risk(f.purchases_timed).withColumn("guess", guess)
    return metrics.classification_metrics(rows, "risk_label", "guess")


@query("ml_07_classifier_quality")
def _(f):
    m = fitted(f, "supplier")
    return metrics.classification_metrics(m.classifier.transform(m.test), "risk_label", "prediction")


@query(
    "ml_08_rule_quality",
    """SELECT sqrt(avg((p - a) * (p - a))) AS rmse, 1 - sum((p - a) * (p - a)) / sum((a - m) * (a - m)) AS r2
       FROM (SELECT CAST(50 * is_late + 10 AS DOUBLE) AS p, CAST(risk_points AS DOUBLE) AS a, avg(risk_points) OVER () AS m FROM risk) AS s""",
    r4="rmse r2",
)
def _(f):
    rows = features.delivery_risk(f.purchases_timed).withColumn("prediction", F.col("is_late") * 50.0 + 10.0)
    return metrics.regression_quality(rows, "risk_points")


@query("ml_08_regressor_quality")
def _(f):
    m = fitted(f, "supplier")
    return metrics.regression_quality(m.regressor.transform(m.test), "risk_points")


@query("ml_09_price_importances")
def _(f):
    models_ = fitted(f, "price")
    return models.importances(f.market, models_.models["GBT"], features.PRICE_FEATURES)


@query("ml_09_supplier_importances")
def _(f):
    return models.importances(f.market, fitted(f, "supplier").classifier, features.SUPPLIER_FEATURES)


@query("ml_10_price_predictions")
def _(f):
    m = fitted(f, "price")
    return models.price_predictions(m.predictions, m.best, TEST_TENANT).drop("created_at")


@query("ml_10_demand_forecasts")
def _(f):
    m = fitted(f, "demand")
    return models.demand_forecasts(m.predictions, m.best, TEST_TENANT).drop("created_at")


@query("ml_10_supplier_risk_scores")
def _(f):
    return models.supplier_risk_scores(fitted(f, "supplier"), TEST_TENANT).drop("created_at")


@query("ml_10_top_04_model_extremes")
def _(f):
    scores = models.supplier_risk_scores(fitted(f, "supplier"), TEST_TENANT)
    return metrics.extremes(scores, score="risk_score").select("supplier_name", "risk_score", "risk_level")
