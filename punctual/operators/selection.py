"""Feature selection per cluster by four selectors and a vote."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators.assoc import average_ranks, correlations_with
from punctual.operators.forest import ForestRows
from punctual.operators.regress import cluster_labels, moments
from punctual.operators.tables import pivot_first
from punctual.staging import stage

# Settings of the selectors.
SEED = 42
RANKING_FOREST = {"numTrees": 50, "maxDepth": 10, "seed": SEED}
LASSO = {"elasticNetParam": 1.0, "regParam": 0.1}
#: Rounds of coordinate descent at most; a few dozen are the rule.
DESCENTS = 10_000
TOP = 10
VOTES = 2


_shared: ContextVar[dict | None] = ContextVar("shared", default=None)


@contextmanager
def shared_forests() -> Iterator[None]:
    """Selectors called inside on the same frame and columns share its written rows and the forests that they have in common."""
    held: dict[tuple, tuple] = {}
    token = _shared.set(held)
    try:
        yield
    finally:
        _shared.reset(token)
        for _, rows, _ in held.values():
            rows.release()


@contextmanager
def _forests(df: DataFrame, features: Sequence[str], label: str, cluster: str) -> Iterator[tuple[ForestRows, dict]]:
    """The rows of all clusters, and the importances that were found on them."""
    held, key = _shared.get(), (id(df), tuple(features), label, cluster)
    if held is not None and key in held:
        yield held[key][1:]
        return
    columns = list(dict.fromkeys([*features, label, cluster]))
    table = stage(df.select(*columns).filter(F.col(cluster).isNotNull()), "selector-rows")
    rows = ForestRows(table, {c: list(features) for c in cluster_labels(table, cluster)}, label, cluster)
    if held is not None:
        held[key] = df, rows, {}
        yield held[key][1:]
        return
    yield rows, {}
    rows.release()


def _importance(rows: ForestRows, found: dict, features: Mapping[Any, Sequence[str]], settings: dict) -> dict[Any, dict[str, float]]:
    """The importances of each cluster's features, from forests which grow in the same passes; those found before are taken from ``found``."""
    wanted = {**RANKING_FOREST, **settings}
    key = tuple((c, tuple(fs)) for c, fs in features.items()), tuple(sorted(wanted.items()))
    if key not in found:
        found[key] = {c: dict(zip(f.features, map(float, f.featureImportances.toArray()))) for c, f in rows.fit(features, **wanted).items()}
    return found[key]


def forest_importance(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", top: int = TOP, **settings,
) -> DataFrame:
    """``(cluster, feature, importance)`` of the ``top`` features of a forest per cluster."""
    with _forests(df, features, label, cluster) as (table, before):
        found = _importance(table, before, {c: list(features) for c in table.clusters}, settings)
    best = {c: sorted(by.items(), key=lambda x: (-x[1], features.index(x[0])))[:top] for c, by in found.items()}
    rows = [(int(c), f, round(s, 4)) for c, chosen in best.items() for f, s in chosen]
    return df.sparkSession.createDataFrame(rows, "cluster int, feature string, importance double")


def recursive_elimination(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", keep: int = TOP, **settings,
) -> DataFrame:
    """``(cluster, feature)`` left after dropping the least important feature and refitting, until ``keep`` are left.

    The rows are written once; the forests of all clusters for one number of features grow together.
    """
    with _forests(df, features, label, cluster) as (table, before):
        left = {c: list(features) for c in table.clusters}
        for _ in range(len(features) - keep):
            for c, found in _importance(table, before, left, settings).items():
                left[c].remove(min(left[c], key=lambda f: (found[f], left[c].index(f))))
    rows = [(int(c), f) for c, fs in left.items() for f in fs]
    return df.sparkSession.createDataFrame(rows, "cluster int, feature string")


def _descend(cov: np.ndarray, penalty: float) -> np.ndarray:
    """Coefficients which minimise half the mean squared error and ``penalty`` times the absolute sum of coefficients by deviation.

    Coordinate descent on the covariances, the label last. Deviations divide by the number of rows, and a constant column's coefficient is 0.
    """
    p = len(cov) - 1
    deviation = np.sqrt(np.maximum(np.diag(cov), 0))
    slope = np.zeros(p)
    moving = [j for j in range(p) if deviation[j] > 0] if deviation[p] > 0 else []
    for _ in range(DESCENTS):
        furthest = 0.0
        for j in moving:
            along = cov[j, p] - cov[j, :p] @ slope + cov[j, j] * slope[j]
            new = np.sign(along) * max(abs(along) - penalty * deviation[j], 0.0) / cov[j, j]
            furthest = max(furthest, abs(new - slope[j]) * deviation[j])
            slope[j] = new
        if furthest <= 1e-13 * deviation[p]:
            break
    return slope


def lasso_coefficients(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", regParam: float = LASSO["regParam"],
) -> dict[Any, dict[str, float]]:
    """The lasso of every cluster, from one aggregate; p squared numbers per cluster come to the driver."""
    _, cov = moments(df, features, label, cluster)
    return {value: dict(zip(features, map(float, _descend(cov[value], regParam)))) for value in sorted(cov)}


def lasso_selection(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", regParam: float = LASSO["regParam"],
) -> DataFrame:
    """``(cluster, feature, coefficient)`` of the features a lasso keeps."""
    found = lasso_coefficients(df, features, label, cluster, regParam)
    rows = [(int(c), f, round(v, 4)) for c, slopes in found.items() for f, v in slopes.items() if v != 0]
    return df.sparkSession.createDataFrame(rows, "cluster int, feature string, coefficient double")


def lasso_conditions(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", regParam: float = LASSO["regParam"], slack: float = 1e-6,
) -> DataFrame:
    """``(cluster, feature, optimal)``: whether the residuals of the lasso, made row by row, go with each feature as its optimum demands.

    The covariance with a kept feature is the penalty with the sign of its coefficient, that with any other no larger.
    """
    found = lasso_coefficients(df, features, label, cluster, regParam)
    complete = df.dropna(subset=[cluster, *features, label])
    slopes = F.create_map(*[x for c, by in found.items() for x in (F.lit(c), F.array(*[F.lit(by[f]) for f in features]))]) if found else F.create_map()
    slope = F.col("_slopes")
    fitted = sum((slope[i] * F.col(f).cast("double") for i, f in enumerate(features)), F.lit(0.0))
    rest = complete.withColumn("_slopes", slopes[F.col(cluster)]).withColumn("_rest", F.col(label).cast("double") - fitted)
    by_feature = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"), slope[i].alias("slope")) for i, f in enumerate(features)])
    sums = rest.select(cluster, "_rest", F.inline(by_feature)).groupBy(cluster, "feature", "slope").agg(
        F.covar_pop("x", "_rest").alias("along"), (F.lit(regParam) * F.stddev_pop("x")).alias("most"))
    near = F.lit(slack) * (F.col("most") + F.lit(1e-9)) + F.lit(1e-12)
    kept = F.abs(F.col("along") - F.signum("slope") * F.col("most")) <= near
    return sums.select(cluster, "feature", F.when(F.col("slope") != 0, kept).otherwise(F.abs("along") <= F.col("most") + near).alias("optimal"))


def spearman_ranking(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", digits: int = 4
) -> DataFrame:
    """``(cluster, feature, correlation, rank)`` by strength of the rank correlation with the label.

    All clusters are ranked in the same jobs. An undefined correlation counts as 0, and features of
    equal strength rank in their given order.
    """
    columns = [*features, label]
    complete = df.select(cluster, *columns).dropna()
    ranked = average_ranks(complete, columns, within=cluster)
    # Callers read the ranking several times.
    strengths = stage(correlations_with(ranked, [f"{f}_rank" for f in features], f"{label}_rank", [cluster]), "strengths")
    named = strengths.select(
        cluster, "place", F.get(F.array(*[F.lit(f) for f in features]), F.col("place")).alias("feature"),
        F.round(F.coalesce(F.col("correlation"), F.lit(0.0)), digits).alias("correlation"),
    )
    order = Window.partitionBy(cluster).orderBy(F.abs("correlation").desc(), "place")
    return named.withColumn("rank", F.row_number().over(order)).drop("place")


# --- matrices and vote --------------------------------------------------------------------------

def importance_matrix(rows: DataFrame, clusters: Sequence, value: str = "importance") -> DataFrame:
    """Features by clusters; a feature outside a cluster's list has no value there."""
    return pivot_first(rows, "feature", "cluster", value, clusters, prefix="cluster_")


def coefficient_matrix(rows: DataFrame, clusters: Sequence) -> DataFrame:
    return pivot_first(rows, "feature", "cluster", "coefficient", clusters, fill=F.lit(0), prefix="cluster_")


def selected_matrix(rows: DataFrame, clusters: Sequence, yes: str = "✓", no: str = "-") -> DataFrame:
    marked = rows.select("feature", "cluster", F.lit(yes).alias("mark"))
    return pivot_first(marked, "feature", "cluster", "mark", clusters, fill=F.lit(no), prefix="cluster_")


def rank_matrix(rows: DataFrame, clusters: Sequence, feature_count: int) -> DataFrame:
    """Ranks by cluster; a feature absent from a cluster ranks behind all others."""
    return pivot_first(rows, "feature", "cluster", "rank", clusters, fill=F.lit(feature_count + 1), prefix="cluster_")


def vote(selections: Mapping[str, DataFrame], threshold: int = VOTES) -> DataFrame:
    """``(cluster, feature, votes, chosen)`` over the selectors' ``(cluster, feature)`` tables."""
    ballots = None
    for name, table in selections.items():
        one = table.select("cluster", "feature").distinct().withColumn("selector", F.lit(name))
        ballots = one if ballots is None else ballots.unionByName(one)
    counted = ballots.groupBy("cluster", "feature").agg(F.count(F.lit(1)).alias("votes"))
    return counted.withColumn("chosen", (F.col("votes") >= threshold).cast("int"))


def vote_matrix(votes: DataFrame, clusters: Sequence) -> DataFrame:
    """0/1 by feature and cluster, the most often chosen features first."""
    wide = pivot_first(votes, "feature", "cluster", "chosen", clusters, fill=F.lit(0), prefix="cluster_")
    total = sum((F.col(f"cluster_{c}") for c in clusters), F.lit(0))
    return wide.withColumn("total", total).orderBy(F.desc("total"), "feature")


def chosen_features(votes: DataFrame, order: Sequence[str]) -> dict[int, list[str]]:
    """The voted features of each cluster, for the per-cluster models."""
    chosen: dict[int, list[str]] = {}
    for r in votes.filter(F.col("chosen") == 1).select("cluster", "feature").collect():
        chosen.setdefault(r["cluster"], []).append(r["feature"])
    return {c: sorted(fs, key=list(order).index) for c, fs in sorted(chosen.items())}
