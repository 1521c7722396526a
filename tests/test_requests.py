"""The scorer of requests: saved and loaded whole, unseen labels, errors on rows kept from training."""

import itertools

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from aerolag.operators import leastsquares, metrics, rank, subtrees
from aerolag.plans import models, requests


@pytest.fixture(scope="module")
def flights(spark):
    return spark.range(900).select(
        (F.col("id") % 12 + 1).cast("int").alias("MONTH"),
        (F.col("id") % 28 + 1).cast("int").alias("DAY"),
        F.concat(F.lit("C"), F.col("id") % 3).alias("OP_CARRIER"),
        F.concat(F.lit("A"), F.col("id") % 5).alias("ORIGIN"),
        F.concat(F.lit("A"), F.col("id") % 7).alias("DEST"),
        F.when(F.col("id") % 50 > 0, (F.col("id") % 3 * 10).cast("double")).alias("ARR_DELAY"),
    )


REQUESTS = [(1, 2, "C2", "A1", "A3"), (1, 2, "new", "A1", "nowhere"), (None, 2, None, "A1", "A2")]
SCHEMA = "MONTH int, DAY int, OP_CARRIER string, ORIGIN string, DEST string"


def test_scorer_is_saved_and_loaded_whole(spark, flights, tmp_path):
    scorer = requests.fit_requests(flights, max_depth=4)
    asked = spark.createDataFrame(REQUESTS, SCHEMA)
    scored = scorer.transform(asked).collect()
    assert len(scored) == 3 and all(row["prediction"] is not None for row in scored)
    assert next(r for r in scored if r["OP_CARRIER"] == "C2")["prediction"] == pytest.approx(20.0, abs=3)
    path = str(tmp_path / "scorer")
    scorer.save(spark, path)
    again = requests.RequestScorer.load(spark, path)
    assert sorted(map(str, again.transform(asked).collect())) == sorted(map(str, scored))
    assert again.errors == scorer.errors


def test_errors_are_those_of_rows_kept_from_training(flights):
    scorer = requests.fit_requests(flights, max_depth=4)
    train, test = requests.split_requests(flights)
    assert train.count() + test.count() == 900 and train.join(test, train.columns, "left_semi").isEmpty()
    scored = scorer.transform(test.select(*models.REQUEST_FEATURES, F.coalesce("ARR_DELAY", F.lit(0.0)).alias("ARR_DELAY")))
    assert metrics.regression_metrics(scored, "ARR_DELAY").first().asDict() == pytest.approx(scorer.errors)
    assert set(scorer.errors) == {"mae", "mse", "rmse", "r2"}


def test_deep_tree_is_grown_below_the_leaves_of_its_top(spark, tmp_path):
    """Equal to the tree that MLlib grows whole, whose bins are those of all rows here."""
    rows = spark.range(4000).selectExpr(
        "CAST(id % 40 AS DOUBLE) AS a", "CAST(id DIV 40 % 50 AS DOUBLE) AS b", "CAST(pmod(xxhash64(id), 1000) AS DOUBLE) AS y"
    )
    whole = models.fit_tree_regressor(rows, ["a", "b"], "y", 12, 5).transform(rows)
    expected = sorted((row["a"], row["b"], row["y"], round(row["prediction"], 6)) for row in whole.collect())
    assert len({row[3] for row in expected}) > 200
    deep = models.fit_deep_tree(rows, ["a", "b"], "y", 12, 5, whole_rows=100, top_depth=3)
    assert deep.stages[-2].depth == 3 and isinstance(deep.stages[-1], subtrees.Subtrees)
    deep.write().overwrite().save(str(tmp_path / "deep"))
    for model in (deep, PipelineModel.load(str(tmp_path / "deep"))):
        found = model.transform(rows).collect()
        assert sorted((row["a"], row["b"], row["y"], round(row["prediction"], 6)) for row in found) == expected


def test_subtree_is_that_of_an_exhaustive_search():
    draw = np.random.default_rng(3)
    bins, n = draw.integers(0, 12, (300, 3)).astype(np.uint8), draw.integers(1, 4, 300).astype(float)
    s = draw.normal(size=300) * n
    feature, cut, child, prediction = subtrees.subtree(bins, n, s, 5, 20)

    def check(at, rows, depth):
        assert prediction[at] == pytest.approx(s[rows].sum() / n[rows].sum())
        gains = {}
        for f, c in itertools.product(range(3), range(12)):
            sides = [rows & (bins[:, f] <= c), rows & (bins[:, f] > c)]
            if min(n[side].sum() for side in sides) >= 20:
                gains[f, c] = sum(s[side].sum() ** 2 / n[side].sum() for side in sides)
        if depth == 0 or not gains:
            assert feature[at] == -1
            return 1
        f, c = feature[at], cut[at]
        assert gains[f, c] == pytest.approx(max(gains.values()))
        below = [check(child[at] + i, rows & side, depth - 1) for i, side in enumerate((bins[:, f] <= c, bins[:, f] > c))]
        return 1 + sum(below)

    assert check(0, np.ones(300, bool), 5) == len(feature) > 20


def test_scorer_in_two_parts_keeps_every_request(spark, flights, tmp_path):
    scorer = requests.fit_requests(flights, max_depth=14, whole_rows=0)
    assert isinstance(scorer.pipeline.stages[-1], subtrees.Subtrees)
    path = str(tmp_path / "scorer")
    scorer.save(spark, path)
    asked = spark.createDataFrame(REQUESTS * 3, SCHEMA)
    for model in (scorer, requests.RequestScorer.load(spark, path)):
        scored = model.transform(asked).collect()
        assert sorted(str(row[:5]) for row in scored) == sorted(str(row[:5]) for row in asked.collect())
        assert all(row["prediction"] is not None for row in scored)
        assert [row["prediction"] for row in scored if row["OP_CARRIER"] == "C2"] == [pytest.approx(20.0, abs=3)] * 3


def test_logistic_rows_are_sparse_and_drop_the_first_value(spark):
    rows = spark.range(600).select(
        F.concat(F.lit("v"), F.format_string("%03d", F.col("id") % 200)).alias("v"),
        (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 200 >= 100).cast("double").alias("label"),
    )
    codes = rank.dense_codes(rows, ["v"]).cache()
    coded = models.encode_all(rows, codes, ["v"])
    model = models.fit_logistic_sparse(coded, codes, ["v"], ["x"], "label")
    more = coded.union(spark.createDataFrame([(5.0, 1.0, -1)], "x double, label double, v int").select(*coded.columns))
    scored = model.transform(more).collect()
    dummies = rank.one_hot(rows, ["v"], codes).select("v", "dummies").distinct().collect()
    assert {tuple(r["dummies"]["indices"]) for r in dummies} == {(), *((i,) for i in range(199))}
    for row in scored:
        places = [int(i) for i in row["v_dummies"].indices]
        assert isinstance(row["features"], SparseVector) and row["features"].size == 200
        assert places == ([row["v"] - 1] if row["v"] > 0 else [])
    assert sum(r["prediction"] == r["label"] for r in scored) > 590


def test_least_squares_weights_nulls_collinear_and_saving(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 17 + 4 AS DOUBLE) AS b", "7D AS k",
        "IF(id % 40 = 0, NULL, 2D * (id % 17) + 1) AS y", "CAST(id % 3 + 1 AS DOUBLE) AS w",
    )
    model = leastsquares.fit(rows, ["a", "b", "k"], "y", F.col("w"))
    scored = model.transform(rows.where("y IS NOT NULL"))
    assert metrics.regression_metrics(scored, "y").first()["rmse"] < 1e-9
    model.save(spark, str(tmp_path / "m"))
    assert leastsquares.LinearModel.load(spark, str(tmp_path / "m")) == model
    assert leastsquares.fit(rows.where("false"), ["a"], "y").coefficients == [0.0]


def test_logistic_training_has_no_more_partitions_than_run_at_once(spark, monkeypatch):
    seen = []

    class Watched(models.Pipeline):
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return super().fit(rows)

    monkeypatch.setattr(models, "Pipeline", Watched)
    rows = spark.range(400, numPartitions=60).select(
        (F.col("id") % 5).cast("int").alias("v"), (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 5 >= 2).cast("double").alias("label"),
    )
    codes = spark.createDataFrame([("v", str(i), i) for i in range(5)], "name string, value string, code int")
    model = models.fit_logistic_sparse(rows, codes, ["v"], ["x"], "label", 5)
    assert 1 <= seen[0] <= spark.sparkContext.defaultParallelism
    assert model.transform(rows).where("prediction = label").count() == 400
