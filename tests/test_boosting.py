"""Boosted trees against a plain version, against each other by rounds, and against the library's quality."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.operators import boosting, regress

FEATURES = ["x", "z", "u"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(21)
    rows = []
    for i in range(1500):
        c = i % 3 if i % 50 else None
        x, z, u = rng.gauss(0, 1), float(rng.randrange(6)), rng.random()
        y = (3 if c else -2) * x * (z > 2) + z + rng.gauss(0, 0.1)
        rows.append((c, x if i % 40 else None, z, u, y if i % 77 else None))
    return spark.createDataFrame(rows, "cluster int, x double, z double, u double, y double").repartition(3).cache()


def plain(bins, y, setting, rounds):
    """Predictions after each round, node by node."""
    def grow(at, target, depth):
        best = None
        if depth < setting.maxDepth:
            for f in range(bins.shape[1]):
                for cut in range(boosting.BINS - 1):
                    left = at & (bins[:, f] <= cut)
                    right = at & ~left
                    if min(left.sum(), right.sum()) >= max(setting.minInstancesPerNode, 1):
                        gain = target[left].sum() ** 2 / left.sum() + target[right].sum() ** 2 / right.sum() - target[at].sum() ** 2 / at.sum()
                        if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12) + 1e-12):
                            best = gain, left, right
        if best is None:
            out[at] = target[at].mean()
        else:
            grow(best[1], target, depth + 1)
            grow(best[2], target, depth + 1)

    told, result = np.zeros(len(y)), []
    for r in range(rounds):
        out = np.zeros(len(y))
        grow(np.ones(len(y), bool), y if r == 0 else 2 * (y - told), 0)
        told = told + (setting.stepSize if r else 1.0) * out
        result.append(told)
    return result


@pytest.mark.parametrize("direct", [64 << 20, 0])
def test_trees_equal_the_plain_version(frame, monkeypatch, direct):
    monkeypatch.setattr(boosting, "DIRECT_BYTES", direct)
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    monkeypatch.setattr(boosting, "WRITTEN_AFTER", 2)
    settings = [boosting.Setting(2, 1, 0.1), boosting.Setting(4, 5, 0.3)]
    grown = boosting.grow(frame, {c: FEATURES for c in range(3)}, "y", settings, 3)
    rows = frame.dropna().collect()
    for c in range(3):
        values = np.array([[r[f] for f in FEATURES] for r in rows if r["cluster"] == c])
        y = np.array([r["y"] for r in rows if r["cluster"] == c])
        bins = boosting.binned(values, grown.thresholds[c])
        for i, setting in enumerate(settings):
            want = plain(bins, y, setting, 3)
            for rounds in (1, 2, 3):
                assert grown.model(c, i).predict(values, rounds) == pytest.approx(want[rounds - 1], abs=1e-9)


def test_longer_fits_begin_with_the_shorter_ones(spark, frame):
    held = regress.held_out(["cluster", *FEATURES, "y"], 0.2, 1)
    runs = {n: boosting.grow(frame, {0: FEATURES, 1: FEATURES}, "y", [boosting.Setting(2, 1, 0.1)], n, held=held) for n in (50, 100)}
    for c in (0, 1):
        short, long = (runs[n].trees[c, 0] for n in (50, 100))
        assert len(short) == 50 and len(long) == 100
        for a, b in zip(short, long):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and np.allclose(a.value, b.value, atol=1e-9)
        assert runs[50].scores[c, 0] == pytest.approx(runs[100].scores[c, 0][:50], abs=1e-9)


def test_scores_are_those_of_the_rows_held_out(frame):
    held = regress.held_out(["cluster", *FEATURES, "y"], 0.2, 1)
    grown = boosting.grow(frame, {1: FEATURES}, "y", [boosting.Setting(3, 1, 0.2)], 6, held=held)
    rows = frame.dropna().filter((F.col("cluster") == 1) & held).collect()
    y, values = np.array([r["y"] for r in rows]), np.array([[r[f] for f in FEATURES] for r in rows])
    for rounds in (1, 6):
        told = grown.model(1, 0).predict(values, rounds)
        assert grown.scores[1, 0][rounds - 1] == pytest.approx(1 - np.square(y - told).sum() / np.square(y - y.mean()).sum(), abs=1e-9)


def test_tuning_reports_all_settings_and_scores(frame):
    grid = {"maxIter": [2, 12], "maxDepth": [1, 4], "minInstancesPerNode": [1, 2], "stepSize": [0.05, 0.2]}
    frames = {"train": frame, "test": frame.sample(0.5, 3)}
    tuned = boosting.tune(frame, FEATURES, "y", grid)
    rows = boosting.score(tuned, frames, FEATURES, "y").collect()
    assert len(rows) == 3 * 16 and sum(r["chosen"] for r in rows) == 3
    for r in rows:
        assert (r["train_r2"] is not None) == r["chosen"]
        if r["chosen"]:
            assert r["maxIter"] == 12 and r["maxDepth"] == 4 and r["train_r2"] > 0.95
            assert r["validation_r2"] == max(x["validation_r2"] for x in rows if x["cluster"] == r["cluster"])
            assert len(tuned.models[r["cluster"]].trees) == 12


def test_quality_is_the_librarys(frame):
    theirs = regress.fit_per_cluster(frame, FEATURES, "y", "boosting", maxIter=10)
    grown = boosting.grow(frame, {c: FEATURES for c in range(3)}, "y", [boosting.Setting(5, 1, 0.1)], 10)
    ours = boosting.predict({c: grown.model(c, 0) for c in range(3)}, frame, {c: FEATURES for c in range(3)}, "y")
    r2 = [{r["cluster"]: r["r2"] for r in regress.regression_scores(p, "y", ["cluster"]).collect()}
          for p in (ours, regress.predict_per_cluster(theirs, frame, FEATURES, "y"))]
    assert r2[0].keys() == r2[1].keys() and all(r2[0][c] == pytest.approx(r2[1][c], abs=0.02) for c in r2[0])


def test_features_may_differ_and_flat_ones_never_split(frame):
    flat = frame.withColumn("flat", F.lit(1.0))
    grown = boosting.grow(flat, {0: ["z"], 1: ["flat"]}, "y", [boosting.Setting(3, 1, 0.1)], 2)
    z, other = grown.features[0].index("z"), grown.trees[1, 0][0]
    assert {int(f) for t in grown.trees[0, 0] for f in t.feature} <= {-1, z} and (other.feature == -1).all()
    kept = flat.filter((F.col("cluster") == 1) & F.col("y").isNotNull()).agg(F.avg("y")).first()[0]
    assert other.value[0] == pytest.approx(kept)


def test_empty_frames(frame):
    grown = boosting.grow(frame.limit(0), {0: FEATURES}, "y", [boosting.Setting()], 2)
    assert grown.clusters == [] and grown.trees == {}


def test_fits_are_the_librarys(frame):
    from pyspark.ml.regression import GBTRegressor

    models = boosting.fit_boosted(frame, FEATURES, "y", maxIter=4)
    for c, model in models.items():
        rows = regress.cluster_rows(frame, "cluster", c, [*FEATURES, "y"])
        theirs = regress.model_pipeline(FEATURES, GBTRegressor(featuresCol="features", labelCol="y", **{**regress.BOOSTING, "maxIter": 4})).fit(rows)
        told = [np.array([r["prediction"] for r in m.transform(rows).orderBy(*FEATURES, "y").collect()]) for m in (model, theirs)]
        assert told[0] == pytest.approx(told[1], rel=1e-9)
        assert model.featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-4)  # equal splits by two features may differ


def test_tasks_follow_the_cores(frame, monkeypatch):
    # Every task sends the sums of its models, so their number must not follow the rows.
    monkeypatch.setattr(boosting, "TASK_ROWS", 1)
    counts = []
    spread = boosting._spread
    monkeypatch.setattr(boosting, "_spread", lambda packed, tasks: counts.append(tasks) or spread(packed, tasks))
    grown = boosting.grow(frame, {c: FEATURES for c in range(3)}, "y", [boosting.Setting(2, 1, 0.1)], 2)
    assert len(grown.trees[0, 0]) == 2
    assert counts == [2 * frame.sparkSession.sparkContext.defaultParallelism]
