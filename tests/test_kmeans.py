"""K-means of several k against a plain version and the library's scores."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from punctual.operators import kmeans


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 1, (120, 3)) for c in ((0, 0, 0), (6, 0, 0), (0, 7, 2), (-5, -5, 5))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a hot vector
    df = spark.createDataFrame(rows, "id int, x array<double>").repartition(5)
    return df.select("id", "x", array_to_vector("x").alias("features")).cache()


def lloyd(x, centres, rounds):
    for _ in range(rounds):
        place = np.square(x[:, None] - centres[None]).sum(axis=2).argmin(axis=1)
        new = np.array([x[place == c].mean(axis=0) if (place == c).any() else centres[c] for c in range(len(centres))])
        if np.square(new - centres).sum(axis=1).max() <= kmeans.TOLERANCE ** 2:
            return new
        centres = new
    return centres


def test_equals_the_plain_version(points):
    x = np.array([r["x"] for r in points.collect()])
    sample = np.unique(x, axis=0)
    found = kmeans.fit(points, [2, 4, 5], silhouettes=True)
    for k, fit in found.items():
        start = kmeans.fit(points, [k], rounds=0)[k].centres
        assert len(np.unique(start, axis=0)) == k and all((sample == s).all(axis=1).any() for s in start)
        assert fit.centres == pytest.approx(lloyd(x, start, kmeans.ROUNDS), abs=1e-9)
        place, far = kmeans.nearest(x, fit.centres)
        assert fit.cost == pytest.approx(far.sum())
        labelled = fit.transform(points)
        assert fit.silhouette == pytest.approx(ClusteringEvaluator(predictionCol="cluster").evaluate(labelled), abs=1e-9)


def test_cost_is_the_librarys(points):
    theirs = KMeans(k=4, seed=42).fit(points)
    assert kmeans.fit(points, [4])[4].cost <= 1.02 * theirs.summary.trainingCost


def test_settled(points):
    fit = kmeans.fit(points.select("x"), [4], "x", rounds=100, tolerance=0.0)[4]
    row = kmeans.settled(fit.transform(points), fit).first()
    assert tuple(row) == (680, 0, True)
    moved = kmeans.KMeansFit(fit.centres + [3, 0, 0], "x", "cluster")
    row = kmeans.settled(moved.transform(points), moved).first()
    assert row["nearer_elsewhere"] > 0 and not row["centres_are_means"]


def test_layout_does_not_matter(points):
    a, b = (kmeans.fit(points.repartition(n), [3])[3].centres for n in (1, 9))
    assert a == pytest.approx(b, abs=1e-9)


def test_odd_rows(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0]), (4, None), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    fit = kmeans.fit(df, [4], "x", silhouettes=True)[4]
    assert len(fit.centres) == 2  # as many as there are vectors
    got = {r["id"]: r["cluster"] for r in fit.transform(df).collect()}
    assert got[1] == got[2] != got[3] and got[4] is got[5] is got[6] is None
    assert kmeans.fit(df.limit(0), [2], "x") == {}
    flat = kmeans.fit(df.filter("id < 3"), [2], "x", silhouettes=True)[2]
    assert flat.cost == 0 and flat.silhouette is None


def test_one_pass_a_round(points, monkeypatch):
    passes = []
    summed = kmeans._summed
    monkeypatch.setattr(kmeans, "_summed", lambda *a: passes.append(1) or summed(*a))
    kmeans.fit(points, range(2, 11), rounds=3, tolerance=0.0, silhouettes=True)
    assert len(passes) == 3 + 2
