"""Models recover known relations; metrics agree with MLlib's evaluator."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from aerolag.operators import metrics, scale
from aerolag.plans import models


@pytest.fixture(scope="module")
def line(spark):
    """y = 3 a - 2 b + 5, with no noise."""
    return spark.range(400).select(
        (F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") % 23).cast("double").alias("b"),
        ((F.col("id") % 17) * 3 - (F.col("id") % 23) * 2 + 5).cast("double").alias("y"),
    )


def test_linear_recovers_and_reloads(line, tmp_path):
    model = models.fit_linear(line, ["a", "b"], "y")
    measured = metrics.regression_metrics(model.transform(line), "y").first()
    assert measured["rmse"] < 1e-6 and measured["r2"] > 1 - 1e-9
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(line)
    assert metrics.regression_metrics(again, "y").first()["rmse"] < 1e-6


def boosted_by_hand(points, rounds):
    """AdaBoost.R2 with row weights and weighted least squares, in numpy."""
    x = np.array([[1.0, a, b] for a, b, _ in points])
    y = np.array([v for *_, v in points])
    w = np.ones(len(y))
    fits, weights = [], []
    for _ in range(rounds):
        root = np.sqrt(w)
        fit = np.linalg.lstsq(x * root[:, None], y * root, rcond=None)[0]
        error = np.abs(y - x @ fit)
        loss = (w * error).sum() / w.sum() / error.max()
        if loss >= 0.5 and fits:
            break
        beta = loss / (1 - loss)
        fits.append(fit)
        weights.append(-math.log(beta))
        w = w * beta ** (1 - error / error.max())
    return fits, weights


def test_boosting_follows_the_algorithm(line):
    exact = models.fit_boosted(line, ["a", "b"], "y", rounds=2)
    assert metrics.regression_metrics(exact.transform(line), "y").first()["rmse"] < 1e-6
    bent = line.withColumn("y", F.col("y") + F.col("a") * F.col("a"))
    fits, weights = boosted_by_hand([tuple(row) for row in bent.collect()], 4)
    boosted = models.fit_boosted(bent, ["a", "b"], "y", rounds=4)
    assert len(fits) > 1 and boosted.weights == pytest.approx(weights, rel=1e-6)
    for fit, intercept, coefficients in zip(fits, boosted.intercepts, boosted.coefficients):
        assert [intercept, *coefficients] == pytest.approx(list(fit), rel=1e-6)


def test_weighted_median(spark):
    model = models.BoostedModel(["a"], [1.0, 5.0, 9.0], [[0.0]] * 3, [1.0, 1.0, 5.0])
    assert model.transform(spark.createDataFrame([(0.0,)], "a double")).first()["prediction"] == 9.0
    model.weights = [3.0, 1.0, 1.0]
    assert model.transform(spark.createDataFrame([(0.0,)], "a double")).first()["prediction"] == 1.0


def test_boosted_model_is_saved_and_loaded(spark, tmp_path):
    model = models.BoostedModel(["a"], [1.0, 5.0], [[0.5], [2.0]], [1.0, 3.0])
    model.save(spark, str(tmp_path / "m"))
    assert models.BoostedModel.load(spark, str(tmp_path / "m")) == model


def test_split_keeps_rows_whole_and_repeats(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("a"))
    train, test = models.split(df, 0.25, 5)
    assert train.count() + test.count() == 2000 and train.join(test, "a", "left_semi").isEmpty()
    again = models.split(df.repartition(5), 0.25, 5)[1]
    assert sorted(again.collect()) == sorted(test.collect())


def test_metrics_agree_with_evaluator(spark):
    rows = [(float(i), float(i + i % 5 - 2)) for i in range(50)]
    scored = spark.createDataFrame(rows, "y double, prediction double")
    measured = metrics.regression_metrics(scored, "y").first()
    for name in ("mae", "mse", "rmse", "r2"):
        expected = RegressionEvaluator(labelCol="y", metricName=name).evaluate(scored)
        assert measured[name] == pytest.approx(expected)


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, k double")
    scaled = scale.standardise(df, scale.fit_scaler(df, ["a", "k"]), ["a", "k"])
    assert sorted(tuple(row) for row in scaled.collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_requests_with_unseen_labels_are_scored(spark):
    flights = spark.range(300).select(
        (F.col("id") % 12 + 1).cast("int").alias("MONTH"),
        (F.col("id") % 28 + 1).cast("int").alias("DAY"),
        F.concat(F.lit("C"), F.col("id") % 3).alias("OP_CARRIER"),
        F.concat(F.lit("A"), F.col("id") % 5).alias("ORIGIN"),
        F.concat(F.lit("A"), F.col("id") % 7).alias("DEST"),
        (F.col("id") % 3 * 10).cast("double").alias("ARR_DELAY"),
    )
    codes, model = models.fit_requests(flights, max_depth=4)
    requests = spark.createDataFrame(
        [(1, 2, "C2", "A1", "A3"), (1, 2, "new", "A1", "nowhere")],
        "MONTH int, DAY int, OP_CARRIER string, ORIGIN string, DEST string",
    )
    scored = {row["OP_CARRIER"]: row["prediction"] for row in models.score_requests(requests, codes, model).collect()}
    assert scored["C2"] == pytest.approx(20.0)
    assert scored["new"] is not None
