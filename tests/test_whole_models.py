"""Models that a task boosts from the first round to the last, against those of passes over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from punctual.operators import boosting, regress

FEATURES = ["x", "z", "u"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1200):
        c = i % 2 if i % 60 else None
        x, z, u = rng.gauss(0, 1), float(rng.randrange(6)), rng.random()
        rows.append((c, x if i % 45 else None, z, u, (3 if c else -2) * x * (z > 2) + z + rng.gauss(0, 0.1) if i % 70 else None))
    return spark.createDataFrame(rows, "cluster int, x double, z double, u double, y double").repartition(3).cache()


@pytest.mark.parametrize("direct", [64 << 20, 0])
def test_whole_models_are_those_of_passes(frame, monkeypatch, direct):
    settings = [boosting.Setting(3, 1, 0.1), boosting.Setting(9, 4, 0.3), boosting.Setting(1, 1, 1.0)]
    held = regress.held_out([*FEATURES, "y"], 0.2, 1)
    pairs = {(0, 0), (0, 1), (1, 1), (1, 2)}
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    monkeypatch.setattr(boosting, "DIRECT_BYTES", direct)
    here = boosting.grow(frame, {0: FEATURES, 1: FEATURES[:2]}, "y", settings, 4, held=held, pairs=pairs)
    monkeypatch.setattr(boosting, "HERE_BYTES", 0)
    passes = boosting.grow(frame, {0: FEATURES, 1: FEATURES[:2]}, "y", settings, 4, held=held, pairs=pairs)
    assert here.trees.keys() == passes.trees.keys() == pairs
    for key in pairs:
        assert here.scores[key] == pytest.approx(passes.scores[key], abs=1e-9)
        assert here.lowered[key] == pytest.approx(passes.lowered[key])
        for a, b in zip(here.trees[key], passes.trees[key], strict=True):
            assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and a.value == pytest.approx(b.value, abs=1e-9)


def test_tuning_of_small_clusters_takes_no_job_a_level(frame, monkeypatch):
    # A grid of hundreds of rounds must not start a job for every level of each (tune_gbt).
    monkeypatch.setattr(boosting, "_boosted_by_passes", lambda *a: pytest.fail("a job for each level"))
    tuned = boosting.tune(frame, FEATURES, "y", {"maxIter": [2, 5], "maxDepth": [2, 4], "minInstancesPerNode": [1, 2], "stepSize": [0.1, 0.3]})
    assert tuned.report.count() == 2 * 16 and all(len(m.trees) == 5 for m in tuned.models.values())


def test_fits_draw_the_rows_that_the_library_draws(spark, monkeypatch):
    # Above 10000 rows the thresholds come from a sample, and may be more than 31 (gbt_fit, gbt_importances).
    rows = spark.range(26_000).select(
        (F.col("id") % 2).cast("int").alias("cluster"), F.rand(1).alias("x"), F.floor(F.rand(2) * 7).alias("z"), F.randn(3).alias("u"))
    rows = rows.withColumn("y", F.col("x") * F.col("z") + F.when(F.col("u") > 0.5, 2.0).otherwise(F.col("u")) + F.col("cluster"))
    assert all(not isinstance(m, boosting.Boosted) for m in regress.fit_per_cluster(rows, FEATURES, "y", "boosting", maxIter=1).values())
    monkeypatch.setattr(regress, "LIBRARY_ROWS", 10_000)
    for here in (boosting.HERE_BYTES, 0):
        monkeypatch.setattr(boosting, "HERE_BYTES", here)
        models = regress.fit_per_cluster(rows, FEATURES, "y", "boosting", maxIter=3)
        table = regress.by_cluster(rows, FEATURES, "y", "cluster")
        for c in (0, 1):
            mine = regress.cluster_rows(table, "cluster", c, [*FEATURES, "y"])
            theirs = regress.model_pipeline(FEATURES, regress.estimator("boosting", "y", maxIter=3)).fit(mine)
            assert isinstance(models[c], boosting.Boosted)
            told = [[r["prediction"] for r in m.transform(mine).orderBy(*FEATURES, "y").collect()] for m in (models[c], theirs)]
            assert told[0] == pytest.approx(told[1], rel=1e-9)
            assert models[c].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-6)
