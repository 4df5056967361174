from punctual.plans.clustering import ClusteredSplits, cluster_splits
from punctual.plans.explore import filter_complete, overview
from punctual.plans.graph import edge_table
from punctual.plans.preparation import PreparedSplits, prepare_splits
from punctual.plans.regression import prepare_regression, select_features

__all__ = [
    "ClusteredSplits", "PreparedSplits", "cluster_splits", "edge_table", "filter_complete", "overview",
    "prepare_regression", "prepare_splits", "select_features",
]
