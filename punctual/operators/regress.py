"""Regression models per cluster: fit, score, tune and compare."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions import HASH_SPACE, stable_hash
from punctual.operators.encode import assembler, cast_stage
from punctual.operators.gram import gram
from punctual.staging import stage

# Model settings and tuning grids.
SEED = 42
LINEAR = {"maxIter": 50}
TREE = {"maxDepth": 5, "minInstancesPerNode": 10}
FOREST = {"numTrees": 100, "maxDepth": 7, "seed": SEED}
BOOSTING = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": SEED}
FOREST_GRID = {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4]}
BOOSTING_GRID = {
    "maxIter": [50, 100], "maxDepth": [3, 5, 8], "minInstancesPerNode": [1, 2], "stepSize": [0.05, 0.1, 0.2],
}
TRAIN_RATIO = 0.8

ESTIMATORS: dict[str, tuple[Callable[..., Estimator], dict[str, Any]]] = {
    "linear": (LinearRegression, LINEAR),
    "tree": (DecisionTreeRegressor, TREE),
    "forest": (RandomForestRegressor, FOREST),
    "boosting": (GBTRegressor, BOOSTING),
}

#: Rows of a cluster up to which the library fits boosted trees by itself. In few rows two features often divide a node alike, and which of
#: them the library takes follows the rounding of its sums.
LIBRARY_ROWS = 100_000

Features = Sequence[str] | Mapping[Any, Sequence[str]]


def estimator(kind: str, label: str, **settings) -> Estimator:
    build, defaults = ESTIMATORS[kind]
    return build(featuresCol="features", labelCol=label, **{**defaults, **settings})


def model_pipeline(features: Sequence[str], model: Estimator) -> Pipeline:
    """Cast, assemble, estimate."""
    return Pipeline(stages=[cast_stage(features), assembler([f"{f}_double" for f in features]), model])


def features_of(features: Features, cluster: Any) -> list[str]:
    return list(features[cluster] if isinstance(features, Mapping) else features)


def all_features(features: Features) -> list[str]:
    if isinstance(features, Mapping):
        return list(dict.fromkeys(f for fs in features.values() for f in fs))
    return list(dict.fromkeys(features))


def by_cluster(df: DataFrame, features: Features, label: str, cluster: str) -> DataFrame:
    """The columns a fit needs, written by cluster, so that each fit reads its own folder only."""
    columns = list(dict.fromkeys([*all_features(features), label, cluster]))
    return stage(df.select(*columns).filter(F.col(cluster).isNotNull()), "clusters", partition_by=cluster)


def cluster_labels(df: DataFrame, cluster: str) -> list:
    """Sorted labels; their number is the k of the clustering."""
    return sorted(r[0] for r in df.select(cluster).distinct().collect())


def map_clusters(labels: Sequence, work: Callable[[Any], Any], workers: int = 3) -> dict:
    """Run ``work`` for every cluster, a few Spark jobs at a time."""
    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(labels, pool.map(work, labels)))


def cluster_rows(table: DataFrame, cluster: str, value: Any, required: Sequence[str]) -> DataFrame:
    return table.filter(F.col(cluster) == F.lit(value)).dropna(subset=list(required))


def fit_per_cluster(
    train: DataFrame, features: Features, label: str, kind: str, cluster: str = "cluster", workers: int = 3, **settings
) -> dict[Any, PipelineModel]:
    """One model per cluster. Rows with a missing feature or label are left out. The forests of all clusters grow together, and so do the boosted trees of large ones."""
    if kind == "forest":
        return _forests(train, features, label, cluster, **settings)
    table = by_cluster(train, features, label, cluster)
    labels, models = cluster_labels(table, cluster), {}
    if kind == "boosting" and {*settings} <= {*BOOSTING, "minInstancesPerNode"}:
        from punctual.operators.boosting import boost_clusters

        large = {r[0] for r in table.groupBy(cluster).count().collect() if r["count"] > LIBRARY_ROWS}
        models = boost_clusters(table, {c: features_of(features, c) for c in labels if c in large}, label, cluster, **{**BOOSTING, **settings})
        labels = [c for c in labels if c not in large]

    def fit(value: Any) -> PipelineModel:
        wanted = features_of(features, value)
        rows = cluster_rows(table, cluster, value, [*wanted, label])
        return model_pipeline(wanted, estimator(kind, label, **settings)).fit(rows)

    models.update(map_clusters(labels, fit, workers))
    return dict(sorted(models.items()))


def _forests(train: DataFrame, features: Features, label: str, cluster: str, **settings) -> dict[Any, Any]:
    from punctual.operators.forest import ForestRows

    table = stage(train.select(*dict.fromkeys([*all_features(features), label, cluster])).filter(F.col(cluster).isNotNull()), "forest-table")
    wanted = {c: features_of(features, c) for c in cluster_labels(table, cluster)}
    rows = ForestRows(table, wanted, label, cluster)
    models = rows.fit(wanted, **{**FOREST, **settings})
    rows.release()
    return models


def predict_per_cluster(
    models: Mapping[Any, PipelineModel], df: DataFrame, features: Features, label: str, cluster: str = "cluster"
) -> DataFrame:
    """``(cluster, label, prediction)`` of every row of the modelled clusters."""
    result = None
    for value, model in models.items():
        rows = cluster_rows(df, cluster, value, [*features_of(features, value), label])
        part = model.transform(rows).select(cluster, label, "prediction")
        result = part if result is None else result.unionByName(part)
    return result


def regression_scores(predictions: DataFrame, label: str, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """RMSE, MAE and R² per group from one aggregate. R² is null where the label is constant."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col("prediction")
    n = F.count(error)
    values: dict[str, Column] = {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(F.sum(error * error), F.var_pop(y) * n),
    }
    return predictions.groupBy(*by).agg(*[F.round(v, digits).alias(k) for k, v in values.items()])


def score_per_cluster(
    models: Mapping[Any, PipelineModel], frames: Mapping[str, DataFrame], features: Features, label: str,
    cluster: str = "cluster", digits: int = 4,
) -> DataFrame:
    """``(cluster, split, rmse, mae, r2)`` of every split in one job."""
    result = None
    for split, df in frames.items():
        table = by_cluster(df, features, label, cluster)
        part = predict_per_cluster(models, table, features, label, cluster).withColumn("split", F.lit(split))
        result = part if result is None else result.unionByName(part)
    return regression_scores(result, label, [cluster, "split"], digits)


def coefficients(models: Mapping[Any, PipelineModel], features: Features, df: DataFrame, digits: int = 4) -> DataFrame:
    """``(cluster, term, coefficient)`` of linear models, with the intercept. No value is a negative zero."""
    rows = []
    for value, model in models.items():
        linear = model.stages[-1]
        for f, c in zip(features_of(features, value), linear.coefficients.toArray()):
            rows.append((int(value), f, round(float(c), digits) + 0.0))
        rows.append((int(value), "intercept", round(float(linear.intercept), digits)))
    return df.sparkSession.createDataFrame(rows, "cluster int, term string, coefficient double")


def importances(models: Mapping[Any, PipelineModel], features: Features, df: DataFrame, digits: int = 4) -> DataFrame:
    """``(cluster, feature, importance, rank)`` of tree models."""
    rows = []
    for value, model in models.items():
        scored = zip(features_of(features, value), model.stages[-1].featureImportances.toArray())
        ranked = sorted(scored, key=lambda x: (-x[1], x[0]))
        rows += [(int(value), f, round(float(s), digits), i) for i, (f, s) in enumerate(ranked, start=1)]
    return df.sparkSession.createDataFrame(rows, "cluster int, feature string, importance double, rank int")


def moments(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster"
) -> tuple[dict[Any, np.ndarray], dict[Any, np.ndarray]]:
    """Means and population covariances of the complete rows of each cluster, the label last."""
    columns = [*features, label]
    p = len(columns)
    mean: dict[Any, np.ndarray] = {}
    cov: dict[Any, np.ndarray] = {}
    for r in gram(df.dropna(subset=[cluster, *columns]), columns, [cluster]).collect():
        matrix = cov.setdefault(r[cluster], np.zeros((p, p)))
        matrix[r["_i"], r["_j"]] = matrix[r["_j"], r["_i"]] = r["cxy"]
        if r["_i"] == r["_j"]:
            mean.setdefault(r[cluster], np.zeros(p))[r["_i"]] = r["mean_x"]
            matrix[r["_i"], r["_i"]] = r["cxx"] if r["varies"] else 0.0
    return mean, cov


def linear_closed_form(
    df: DataFrame, features: Sequence[str], label: str, cluster: str = "cluster", digits: int = 4
) -> DataFrame:
    """Least squares of all clusters at once, from one aggregate of means and covariances.

    Only means and covariances come to the driver: (p + 1)(p + 2) / 2 numbers per cluster.
    """
    mean, cov = moments(df, features, label, cluster)
    p = len(features)
    rows = []
    for value in sorted(mean):
        slope = np.linalg.lstsq(cov[value][:p, :p], cov[value][:p, p], rcond=None)[0]
        intercept = mean[value][p] - sum(s * m for s, m in zip(slope, mean[value]))
        rows += [(value, f, round(float(s), digits) + 0.0) for f, s in zip(features, slope)]
        rows.append((value, "intercept", round(float(intercept), digits)))
    return df.sparkSession.createDataFrame(rows, f"`{cluster}` int, term string, coefficient double")


def simple_regression(
    df: DataFrame, feature: str, label: str, cluster: str = "cluster", digits: int = 4
) -> DataFrame:
    """Slope and intercept of the one-feature line of every cluster, all in one aggregate."""
    return df.groupBy(cluster).agg(
        F.round(F.regr_slope(label, feature), digits).alias("slope"),
        F.round(F.regr_intercept(label, feature), digits).alias("intercept"),
    )


def tune_per_cluster(
    train: DataFrame, features: Features, label: str, kind: str, grid: Mapping[str, Sequence], cluster: str = "cluster", **settings,
) -> tuple[dict[Any, Any], DataFrame]:
    """Grid search of forests per cluster on an 80/20 division by R²: the best models, fitted to all rows, and a report of every setting.

    Settings which differ in their number of trees or depth only share a growth (see ``ForestRows.validate``); all clusters grow together.
    The report holds, for each cluster and setting, R² over the rows held out and whether the setting was chosen (the first of equals).
    """
    from punctual.operators.forest import ForestRows

    if kind != "forest":
        raise ValueError(f"no grid search for {kind}; boosting.tune does that of boosted trees")
    table = stage(train.select(*dict.fromkeys([*all_features(features), label, cluster])).filter(F.col(cluster).isNotNull()), "tuning-table")
    wanted = {c: features_of(features, c) for c in cluster_labels(table, cluster)}
    rows = ForestRows(table, wanted, label, cluster, held_out([*all_features(features), label], 1 - TRAIN_RATIO, SEED))
    choices = [{**FOREST, "minInstancesPerNode": 1, **settings, **dict(zip(grid, values))} for values in itertools.product(*grid.values())]
    scores: dict[tuple, float | None] = {}
    for seed, least, sampled in dict.fromkeys((o["seed"], o["minInstancesPerNode"], o["numTrees"] > 1) for o in choices):
        shared = [o for o in choices if (o["seed"], o["minInstancesPerNode"], o["numTrees"] > 1) == (seed, least, sampled)]
        found = rows.validate(wanted, sorted({o["numTrees"] for o in shared}), sorted({o["maxDepth"] for o in shared}), seed, least, sampled)
        scores.update({(c, seed, least, *of): r2 for (c, *of), r2 in found.items()})
    models, told = {}, []
    for c in wanted:
        r2 = [scores.get((c, o["seed"], o["minInstancesPerNode"], o["numTrees"], o["maxDepth"])) for o in choices]
        best = max(range(len(choices)), key=lambda j: (float("-inf") if r2[j] is None else r2[j], -j))
        models.update(rows.fit({c: wanted[c]}, **choices[best]))
        told += [(c, *(float(o[n]) for n in grid), r2[j], j == best) for j, o in enumerate(choices)]
    rows.release()
    return models, tuning_report(train, cluster, grid, told)


def tuning_report(train: DataFrame, cluster: str, grid: Mapping[str, Sequence], rows: Sequence[tuple]) -> DataFrame:
    """``cluster``, a column for each parameter, ``validation_r2``, ``chosen``."""
    kind = train.schema[cluster].dataType.simpleString()
    names = ", ".join(f"{n} double" for n in grid)
    table = train.sparkSession.createDataFrame(list(rows), f"`{cluster}` {kind}, {names}, validation_r2 double, chosen boolean")
    return table.withColumn("validation_r2", F.round("validation_r2", 4))


def scored_report(report: DataFrame, scores: DataFrame, splits: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """The report with RMSE, MAE and R² of each cluster's tuned model in every split, beside the setting that it has."""
    columns = [(s, m) for s in splits for m in ("rmse", "mae", "r2")]
    wide = scores.groupBy(cluster).agg(*[F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s, m in columns])
    return report.join(wide.withColumn("chosen", F.lit(True)), [cluster, "chosen"], "left").select(*report.columns, *[f"{s}_{m}" for s, m in columns])


def held_out(columns: Sequence[str], share: float, seed: int) -> Column:
    """True for about ``share`` of the rows, by a hash of their values: equal rows fall on the same side, and reruns agree."""
    return stable_hash(F.lit(seed).cast("string"), *columns) >= int((1 - share) * HASH_SPACE)


def compare_models(scores: Mapping[str, DataFrame], metric: str, cluster: str = "cluster") -> DataFrame:
    """``(cluster, split)`` rows with one column per model for a metric."""
    result = None
    for name, table in scores.items():
        part = table.select(cluster, "split", F.lit(name).alias("model"), F.col(metric).alias("value"))
        result = part if result is None else result.unionByName(part)
    return result.groupBy(cluster, "split").pivot("model", list(scores)).agg(F.first("value"))
