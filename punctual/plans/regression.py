"""From clustered modelling tables to regression frames and voted features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from punctual.operators import assoc, encode, selection
from punctual.operators.cluster import attach_label
from punctual.plans import columns as names
from punctual.staging import stage

FREQUENCIES = [f"{c}_freq" for c in names.FREQUENCY]


def prepare_regression(
    frames: dict[str, DataFrame],
    labels: dict[str, DataFrame],
    numbers: Sequence[str] = (*names.NUMBERS, *FREQUENCIES),
    vectors: Sequence[str] = tuple(f"{c}_vec" for c in names.ONE_HOT),
    flags: Sequence[str] = tuple(names.FLAGS),
    key: str = "index",
    target: str = names.TARGET,
    train: str = "train",
) -> tuple[dict[str, DataFrame], list[str]]:
    """Attach the cluster map, scale the numbers on the training rows and unfold the one-hot vectors.

    Returns the frames (``cluster``, key, flags, ``<number>_scaled``, ``<vector>_<i>``, target) and
    their feature columns in schema order.
    """
    joined = {name: attach_label(df, labels[name].select(key, "cluster"), [key]) for name, df in frames.items()}
    scaler = encode.fit_scaler(joined[train], numbers)
    scaled = [f"{n}_scaled" for n in numbers]
    slots = {v: [f"{v}_{i}" for i in range(encode.slot_count(joined[train], v))] for v in vectors}
    features = [*flags, *scaled, *[s for names_ in slots.values() for s in names_]]
    result = {}
    for name, df in joined.items():
        wide = encode.scaled_columns(df, scaler, numbers)
        for v, columns in slots.items():
            wide = encode.vector_columns(wide, v, columns)
        # Written here: the correlations, the selectors and the models each read it again.
        result[name] = stage(wide.select("cluster", key, *features, target), f"regression-{name}")
    return result, features


def select_features(
    train: DataFrame, features: Sequence[str], target: str = names.TARGET, cluster: str = "cluster",
    threshold: float = 0.8, top: int = selection.TOP, forest: dict | None = None,
) -> tuple[dict[int, list[str]], DataFrame]:
    """Prune correlated features, run the four selectors per cluster and vote.

    The target is part of the correlation matrix, and the selectors see the pruned list only.
    Returns the chosen features per cluster and the table of votes.
    """
    long = assoc.spearman_long(train, [*features, target]).persist()
    kept = assoc.kept_features(assoc.prune_pairs(long, features, target, threshold), features)
    ranked = selection.spearman_ranking(train, kept, target, cluster)
    forest = forest or {}
    with selection.shared_forests():
        ballots = {
            "forest": selection.forest_importance(train, kept, target, cluster, top, **forest),
            "elimination": selection.recursive_elimination(train, kept, target, cluster, top, **forest),
            "lasso": selection.lasso_selection(train, kept, target, cluster),
            "spearman": ranked.filter(ranked["rank"] <= top),
        }
    votes = selection.vote(ballots).persist()
    return selection.chosen_features(votes, kept), votes
