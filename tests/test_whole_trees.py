"""Trees that a task grows from the root to the leaves, against those grown by passes."""

import random

import numpy as np
import pytest

from punctual.operators import boosting, forest, regress, selection

FEATURES = ["x", "z", "u"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        c = i % 2 if i % 60 else None
        x, z, u = rng.gauss(0, 1), float(rng.randrange(6)), rng.random()
        rows.append((c, x if i % 45 else None, z, u, (3 if c else -2) * x * (z > 2) + z + rng.gauss(0, 0.1) if i % 70 else None))
    return spark.createDataFrame(rows, "cluster int, x double, z double, u double, y double").repartition(3).cache()


@pytest.mark.parametrize("sampled", [True, False])
def test_whole_trees_are_those_of_passes(frame, monkeypatch, sampled):
    monkeypatch.setattr(forest, "TASK_ROWS", 300)
    rows = forest.ForestRows(frame, {c: FEATURES for c in (0, 1)}, "y")
    own = rows._own({0: FEATURES, 1: FEATURES[:2]})
    trees, lowered = rows._grown(own, range(3), 6, 9, 2, sampled, True)
    whole = {(c, t): (tree, by) for c, t, tree, by in rows._grown_here(own, range(3), 6, 9, 2, sampled).collect()}
    assert whole.keys() == trees.keys()
    for key, (tree, by) in whole.items():
        assert (tree.feature == trees[key].feature).all() and (tree.bin == trees[key].bin).all()
        assert tree.value == pytest.approx(trees[key].value) and by == pytest.approx(lowered[key])
    rows.release()


def test_scores_of_whole_trees_are_those_of_passes(frame, monkeypatch):
    held = regress.held_out([*FEATURES, "y"], 0.2, 1)
    rows = forest.ForestRows(frame, {c: FEATURES for c in (0, 1)}, "y", held=held)
    args = {c: FEATURES for c in (0, 1)}, [3, 7], [2, 7, 4], 5, 1, True
    here = rows.validate(*args)
    monkeypatch.setattr(forest, "HERE_BYTES", 0)
    passes = rows.validate(*args)
    assert here.keys() == passes.keys() and len(here) == 2 * 2 * 3
    assert all(here[k] == pytest.approx(passes[k], abs=1e-9) for k in here)
    rows.release()


def test_tuning_of_small_clusters_sends_no_sums(frame, monkeypatch):
    # Deep trees have more cells than the clusters have rows: no pass may send them (tune_forest).
    monkeypatch.setattr(forest.ForestRows, "_splits", lambda *a: pytest.fail("a pass over sums"))
    monkeypatch.setattr(forest, "PASS_BYTES", 1 << 16)
    models, report = regress.tune_per_cluster(frame, FEATURES, "y", "forest", {"numTrees": [3, 8], "maxDepth": [3, 12], "minInstancesPerNode": [1, 4]})
    assert report.count() == 16 and set(models) == {0, 1}


def test_a_cluster_without_held_rows_has_no_score(frame):
    rows = forest.ForestRows(frame, {0: FEATURES}, "y")
    assert rows.validate({0: FEATURES}, [2], [3], 5, 1, True) == {(0, 2, 3): None}
    rows.release()


def test_values_of_a_level_are_those_of_its_leaves():
    rng = np.random.default_rng(3)
    tree = boosting.Tree.empty(7)
    for i in range(2 ** 7 - 1):
        above = (i - 1) // 2
        if i == 0 or (tree.feature[above] >= 0 and rng.random() < 0.8):
            tree.feature[i], tree.bin[i] = rng.integers(0, 3), rng.integers(0, 32)
    tree.value[:] = rng.random(len(tree.value))
    bins = rng.integers(0, 33, (500, 3)).astype(np.uint8)
    for depths in ([7], [2, 6, 7], [7, 3]):
        told = np.zeros((len(depths), 500))
        forest._add_told(told, tree, np.ascontiguousarray(bins.T), bins.reshape(-1), np.arange(500) * 3, depths)
        for i, depth in enumerate(depths):
            assert (told[i] == tree.value[tree.nodes(bins, depth)]).all()


def test_selectors_share_rows_and_forests(frame, monkeypatch):
    # The elimination's first forest is the one that ranks the features (majority_vote, regression_path).
    fits, built = [], []
    fit, init = forest.ForestRows.fit, forest.ForestRows.__init__
    monkeypatch.setattr(forest.ForestRows, "fit", lambda self, features, **s: fits.append(features) or fit(self, features, **s))
    monkeypatch.setattr(forest.ForestRows, "__init__", lambda self, *a, **k: built.append(a) or init(self, *a, **k))

    def both():
        ranked = selection.forest_importance(frame, FEATURES, "y", numTrees=5, maxDepth=4)
        left = selection.recursive_elimination(frame, FEATURES, "y", keep=1, numTrees=5, maxDepth=4)
        return sorted(map(tuple, ranked.collect())), sorted(map(tuple, left.collect()))

    alone = both()
    assert (len(fits), len(built)) == (3, 2)
    with selection.shared_forests():
        assert both() == alone
        assert (len(fits), len(built)) == (5, 3)
    assert both() == alone and len(built) == 5


def test_elimination_of_small_clusters_sends_no_sums(frame, monkeypatch):
    # Where the sums of a pass outweigh the rows, the rows are sent, once for each refit (rfe, elimination_matrix).
    monkeypatch.setattr(forest.ForestRows, "_splits", lambda *a: pytest.fail("a pass over sums"))
    monkeypatch.setattr(forest, "PASS_BYTES", 1 << 16)
    left = selection.recursive_elimination(frame, FEATURES, "y", keep=2, numTrees=20, maxDepth=8)
    assert sorted(map(tuple, left.collect())) == [(0, "x"), (0, "z"), (1, "x"), (1, "z")]
