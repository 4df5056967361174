import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from punctual.operators import regress, selection


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1200):
        x, z, noise = rng.gauss(0, 1), rng.gauss(0, 2), rng.gauss(0, 0.1)
        c = i % 2
        rows.append((c, x, z, rng.random(), 1.0, (3 if c else -2) * x + 0.5 * z + c + noise))
    return spark.createDataFrame(rows, "cluster int, x double, z double, u double, flat double, y double").repartition(3).cache()


def test_closed_form_equals_the_fitted_model(frame, rows):
    fitted = regress.fit_per_cluster(frame, ["x", "z"], "y", "linear")
    a = {(r["cluster"], r["term"]): r["coefficient"] for r in regress.coefficients(fitted, ["x", "z"], frame).collect()}
    b = {(r["cluster"], r["term"]): r["coefficient"] for r in regress.linear_closed_form(frame, ["x", "z"], "y").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=2e-4)
    one = {r["cluster"]: r["slope"] for r in regress.simple_regression(frame, "x", "y").collect()}
    assert one[1] == pytest.approx(3, abs=0.2) and one[0] == pytest.approx(-2, abs=0.2)


def test_scores_equal_the_evaluator(frame):
    models = regress.fit_per_cluster(frame, ["x"], "y", "linear")
    predictions = regress.predict_per_cluster(models, frame, ["x"], "y").cache()
    scores = {r["cluster"]: r for r in regress.regression_scores(predictions, "y", ["cluster"]).collect()}
    for c in (0, 1):
        for metric in ("rmse", "mae", "r2"):
            expected = RegressionEvaluator(labelCol="y", metricName=metric).evaluate(predictions.filter(F.col("cluster") == c))
            assert scores[c][metric] == pytest.approx(expected, abs=1e-4)


def test_features_may_differ_by_cluster(frame):
    features = {0: ["x", "z"], 1: ["x"]}
    models = regress.fit_per_cluster(frame, features, "y", "linear")
    scores = regress.score_per_cluster(models, {"train": frame, "val": frame.sample(0.5, 1)}, features, "y").collect()
    r2 = {(r["cluster"], r["split"]): r["r2"] for r in scores}
    assert len(r2) == 4 and r2[0, "train"] > 0.99 > r2[1, "train"]


def test_trees(frame):
    features = ["x", "z", "u", "flat"]
    settings = {"tree": {}, "forest": {"numTrees": 10}, "boosting": {"maxIter": 8}}
    r2 = {}
    low, high = frame.agg(F.min("y"), F.max("y")).first()
    for kind, extra in settings.items():
        models = regress.fit_per_cluster(frame, features, "y", kind, **extra)
        predictions = regress.predict_per_cluster(models, frame, features, "y")
        if kind != "boosting":  # leaves hold means of the label
            p = predictions.agg(F.min("prediction"), F.max("prediction")).first()
            assert low <= p[0] and p[1] <= high
        r2[kind] = min(r["r2"] for r in regress.regression_scores(predictions, "y", ["cluster"]).collect())
        importance = regress.importances(models, features, frame)
        sums = [r[1] for r in importance.groupBy("cluster").agg(F.sum("importance")).collect()]
        assert sums == pytest.approx([1, 1], abs=1e-3)
        assert {r["feature"] for r in importance.filter("rank = 1").collect()} == {"x"}
    assert r2["boosting"] >= r2["tree"] > 0.5


def test_tuning_reports_the_best(frame):
    models, report = regress.tune_per_cluster(frame, ["x", "z"], "y", "forest", {"numTrees": [2], "maxDepth": [1, 5]})
    got = report.collect()
    assert len(got) == 4 and {(r["cluster"], r["numTrees"], r["maxDepth"]) for r in got if r["chosen"]} == {(0, 2.0, 5.0), (1, 2.0, 5.0)}
    assert all(max(got, key=lambda r: (r["cluster"] == c, r["validation_r2"]))["chosen"] for c in (0, 1))
    assert models[0].stages[-1].getMaxDepth() == 5
    scores = regress.scored_report(report, regress.score_per_cluster(models, {"train": frame, "test": frame}, ["x", "z"], "y"), ["train", "test"])
    for r in scores.collect():
        assert (r["test_r2"] is not None) == r["chosen"] and r["train_rmse"] == r["test_rmse"]


def test_compare_models(spark, rows):
    a = spark.createDataFrame([(0, "val", 1.0)], "cluster int, split string, rmse double")
    b = spark.createDataFrame([(0, "val", 2.0)], "cluster int, split string, rmse double")
    assert rows(regress.compare_models({"a": a, "b": b}, "rmse")) == [(0, "val", 1.0, 2.0)]


def test_selectors(frame, rows):
    features = ["x", "z", "u", "flat"]
    small = {"numTrees": 5, "maxDepth": 4}
    top = selection.forest_importance(frame, features, "y", top=2, **small)
    assert rows(top, "cluster", "feature") == [(0, "x"), (0, "z"), (1, "x"), (1, "z")]
    kept = selection.recursive_elimination(frame, features, "y", keep=2, **small)
    assert rows(kept) == [(0, "x"), (0, "z"), (1, "x"), (1, "z")]
    light = selection.lasso_selection(frame, features, "y")
    heavy = selection.lasso_selection(frame, features, "y", regParam=50.0)
    assert {r["feature"] for r in light.collect()} >= {"x", "z"} and heavy.count() == 0
    ranked = selection.spearman_ranking(frame, features, "y")
    pdf = frame.toPandas()
    for r in ranked.collect():
        part = pdf[pdf.cluster == r["cluster"]]
        expected = part[[r["feature"], "y"]].corr("spearman").iloc[0, 1]
        assert r["correlation"] == pytest.approx(0 if np.isnan(expected) else expected, abs=1e-4)
    last = ranked.filter("rank = 4").collect()
    assert {r["feature"] for r in last} == {"flat"} and {r["correlation"] for r in last} == {0.0}


def test_votes(spark, rows):
    def picks(*pairs):
        return spark.createDataFrame(list(pairs), "cluster int, feature string")

    votes = selection.vote(
        {
            "a": picks((0, "p"), (0, "q"), (1, "p"), (0, "r"), (0, "s")), "b": picks((0, "q"), (0, "r"), (0, "s")),
            "c": picks((0, "r"), (0, "s")), "d": picks((0, "s")),
        }
    )
    assert rows(votes) == [(0, "p", 1, 0), (0, "q", 2, 1), (0, "r", 3, 1), (0, "s", 4, 1), (1, "p", 1, 0)]
    matrix = selection.vote_matrix(votes, [0, 1]).collect()
    assert [tuple(r) for r in matrix] == [("q", 1, 0, 1), ("r", 1, 0, 1), ("s", 1, 0, 1), ("p", 0, 0, 0)]
    assert selection.chosen_features(votes, ["s", "r", "q"]) == {0: ["s", "r", "q"]}


def test_matrices(spark, rows):
    df = spark.createDataFrame([("f", 0, 0.5, 1), ("g", 1, 0.25, 2)], "feature string, cluster int, importance double, rank int")
    assert rows(selection.importance_matrix(df, [0, 1])) == [("f", 0.5, None), ("g", None, 0.25)]
    assert rows(selection.rank_matrix(df, [0, 1], 2)) == [("f", 1, 3), ("g", 3, 2)]
    assert rows(selection.selected_matrix(df, [0, 1])) == [("f", "✓", "-"), ("g", "-", "✓")]
    coefficients = df.withColumnRenamed("importance", "coefficient")
    assert rows(selection.coefficient_matrix(coefficients, [0, 1])) == [("f", 0.5, 0.0), ("g", 0.0, 0.25)]
