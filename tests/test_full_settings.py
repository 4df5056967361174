"""The registered queries of models run with the full settings, grids and numbers of features."""

import pytest

from punctual.catalog import REGISTRY
from punctual.catalog import paths
from punctual.operators import boosting, cluster, regress, selection


class Called(Exception):
    pass


def settings_of(monkeypatch, spark, sf_dir, name, module, function):
    """Arguments with which the query calls the function, which isn't run."""
    def note(*args, **kwargs):
        raise Called(args, kwargs)

    monkeypatch.setattr(module, function, note)
    with pytest.raises(Called) as got:
        REGISTRY[name].run(spark, sf_dir)
    return got.value.args


@pytest.mark.parametrize("name", ["forest_fit", "forest_importances", "gbt_fit", "gbt_importances"])
def test_fits_change_no_setting(monkeypatch, spark, sf_dir, name):
    assert settings_of(monkeypatch, spark, sf_dir, name, regress, "fit_per_cluster")[1] == {}


@pytest.mark.parametrize("name,module,function,grid", [
    ("tune_forest", regress, "tune_per_cluster", regress.FOREST_GRID), ("tune_gbt", boosting, "tune", regress.BOOSTING_GRID)])
def test_tuning_takes_the_whole_grid(monkeypatch, spark, sf_dir, name, module, function, grid):
    args, kwargs = settings_of(monkeypatch, spark, sf_dir, name, module, function)
    assert args[-1] == grid and not kwargs


@pytest.mark.parametrize("name,function", [
    ("forest_top", "forest_importance"), ("rfe", "recursive_elimination"), ("majority_vote", "forest_importance")])
def test_selectors_choose_ten_of_more(monkeypatch, spark, sf_dir, name, function):
    args, kwargs = settings_of(monkeypatch, spark, sf_dir, name, selection, function)
    assert not kwargs and len(args) == 3 and len(args[1]) > selection.TOP == 10


def test_clusters_take_all_of_k(monkeypatch, spark, sf_dir):
    args, kwargs = settings_of(monkeypatch, spark, sf_dir, "k_sweep", cluster, "sweep_k")
    assert len(args) == 1 and not kwargs and list(cluster.SWEEP) == list(range(2, 11))
    args, kwargs = settings_of(monkeypatch, spark, sf_dir, "clustered_tables", paths, "cluster_splits")
    assert len(args) == 1 and not kwargs and cluster.CLUSTERS == 6


def test_regression_path_fits_its_clusters(monkeypatch, spark, sf_dir):
    args, kwargs = settings_of(monkeypatch, spark, sf_dir, "regression_path", paths, "cluster_splits")
    assert len(args) == 1 and not kwargs
