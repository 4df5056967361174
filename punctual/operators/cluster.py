"""Clustering and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators import embedding, kmeans
from punctual.operators.embedding import WordVectors
from punctual.operators.joins import checked_broadcast
from punctual.operators.kmeans import KMeansFit
from punctual.operators.profile import percent, stratum_share
from punctual.operators.quantiles import quantiles
from punctual.operators.tables import counts_of_top_values, share_inside_group
from punctual.staging import stage

# The settings of the embedding and of the clustering.
SEED = 42
EMBEDDING = {"vectorSize": 20, "windowSize": 7, "minCount": 5}
CLUSTERS = 6
SWEEP = range(2, 11)
# Longitude and latitude limits of the route map, ends excluded.
MAP_BOX = {"lon": (-130, -60), "lat": (20, 50)}

#: Parts in which Word2Vec trains, one of its settings like the seed: another number gives other vectors. It never follows the size of the data.
TRAINERS = 32


def fit_embedding(df: DataFrame, tokens: str = "tokens", out: str = "category_vec", **settings) -> WordVectors:
    """Vectors of category tokens from their co-occurrences (see ``embedding``)."""
    return embedding.fit(df, tokens, out, seed=SEED, **{**EMBEDDING, **settings})


def fit_word2vec(
    df: DataFrame, tokens: str = "tokens", out: str = "category_vec", partitions: int = TRAINERS, **settings
) -> Word2VecModel:
    """Word vectors of category tokens, trained in ``partitions`` parts."""
    model = Word2Vec(
        inputCol=tokens, outputCol=out, seed=SEED, numPartitions=partitions, **{**EMBEDDING, **settings}
    )
    return model.fit(df)


def fit_kmeans(df: DataFrame, features: str = "features", k: int = CLUSTERS, label: str = "cluster", **settings) -> KMeansFit:
    return kmeans.fit(df, [k], features, label, seed=SEED, **settings)[k]


def assign(model: KMeansFit, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns with the cluster label: the key travels through the transform, no join needed."""
    return model.transform(df).select(*keep, model.getPredictionCol())


def attach_label(df: DataFrame, labels: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join of a label table (one row per key) onto the rows it was computed from."""
    return df.join(labels, list(key), "left")


def silhouette(df: DataFrame, features: str = "features", label: str = "cluster") -> float:
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=label, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(df)


def sweep_k(df: DataFrame, features: str = "features", ks: Sequence[int] = SWEEP, **settings) -> DataFrame:
    """``(k, cost, silhouette)`` for each k. All of them move in the same passes over the vectors."""
    found = kmeans.fit(df, list(ks), features, seed=SEED, silhouettes=True, **settings)
    rows = [(k, fit.cost, fit.silhouette) for k, fit in found.items()]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


# --- profiles -----------------------------------------------------------------------------------

def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))


def cluster_means(df: DataFrame, columns: Sequence[str], cluster: str = "cluster", digits: int = 6) -> DataFrame:
    return df.groupBy(cluster).agg(*[F.round(F.avg(c), digits).alias(f"avg_{c}") for c in columns])


def cluster_counts(df: DataFrame, column: str, k: int = 50, cluster: str = "cluster") -> DataFrame:
    return counts_of_top_values(df, cluster, column, k)


def cluster_composition(df: DataFrame, column: str, k: int = 20, cluster: str = "cluster") -> DataFrame:
    return share_inside_group(df, cluster, column, k)


def cluster_value_share(df: DataFrame, column: str, cluster: str = "cluster") -> DataFrame:
    """Count and percentage of each value inside its cluster, for all clusters at once."""
    return stratum_share(df, [column], within=[cluster])


def cluster_top_values(df: DataFrame, column: str, k: int = 10, cluster: str = "cluster") -> DataFrame:
    """The ``k`` most frequent values of each cluster with their percentage of the cluster."""
    counts = df.groupBy(cluster, column).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(cluster).agg(F.sum("count").alias("_all"))
    order = Window.partitionBy(cluster).orderBy(F.desc("count"), column)
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(totals, cluster).select(
        cluster, column, "count", percent(F.col("count"), F.col("_all")).alias("percentage"), "rank"
    )


def dominant_cluster(df: DataFrame, keys: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Per key, the cluster with most rows (the smallest label on a tie) and its row count.

    Two hash aggregates with map-side partials; the second sees at most one row per key and cluster.
    """
    counts = df.groupBy(*keys, cluster).agg(F.count(F.lit(1)).alias("count"))
    best = F.max(F.struct(F.col("count"), (-F.col(cluster)).alias("_label")))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, (-F.col("_best._label")).alias(cluster), F.col("_best.count").alias("count")
    )


def _roles(coordinates: DataFrame, code: str, lat: str, lon: str, names: Sequence[str]) -> DataFrame:
    return coordinates.selectExpr(f"`{code}` as {names[0]}", f"`{lat}` as {names[1]}", f"`{lon}` as {names[2]}")


def locate_keys(
    dominant: DataFrame, key: str, coordinates: DataFrame, code: str, lat: str, lon: str, cluster: str = "cluster"
) -> DataFrame:
    """Attach coordinates to the dominant cluster of each place; unknown places keep nulls."""
    places = checked_broadcast(_roles(coordinates, code, lat, lon, ["_code", "latitude", "longitude"]))
    joined = dominant.join(places, F.col(key) == F.col("_code"), "left")
    return joined.select(F.col(key).alias("code"), cluster, "latitude", "longitude").distinct()


def locate_routes(
    dominant: DataFrame, start: str, end: str, coordinates: DataFrame, code: str, lat: str, lon: str,
    box: dict[str, tuple[float, float]] | None = None, cluster: str = "cluster",
) -> DataFrame:
    """Attach both end points to each route; routes with an unknown end or an end outside the box go."""
    box = box or MAP_BOX
    first = checked_broadcast(_roles(coordinates, code, lat, lon, [start, "start_lat", "start_lon"]))
    second = checked_broadcast(_roles(coordinates, code, lat, lon, [end, "end_lat", "end_lon"]))
    ends = ["start_lat", "start_lon", "end_lat", "end_lon"]
    joined = dominant.join(first, start, "left").join(second, end, "left").dropna(subset=ends)

    def within(column: str, side: str) -> Column:
        low, high = box[side]
        return (F.col(column) > low) & (F.col(column) < high)

    inside = joined.filter(within("start_lon", "lon") & within("start_lat", "lat"))
    inside = inside.filter(within("end_lon", "lon") & within("end_lat", "lat"))
    return inside.select(start, end, cluster, "count", *ends).distinct()


def frequent_routes(routes: DataFrame, p: float = 0.9, count: str = "count") -> DataFrame:
    """Routes whose count reaches the interpolated quantile ``p`` of all route counts."""
    table = stage(routes, "routes")
    threshold = quantiles(table, {count: [p]}, interpolate=True)[count, p]
    return table.filter(F.col(count) >= F.lit(threshold))


def category_means(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str], digits: int = 6
) -> DataFrame:
    """``(category, value, measure, mean)`` of every category and number from one scan and one aggregate."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in categories]
    )
    long = df.select(F.inline(pairs), *numbers)
    means = long.groupBy("category", "value").agg(*[F.round(F.avg(n), digits).alias(n) for n in numbers])
    return means.unpivot(["category", "value"], list(numbers), "measure", "mean")
