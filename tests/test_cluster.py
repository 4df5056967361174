import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from punctual.operators import cluster, encode


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(10 * (i % 3), 1), rng.gauss(-5 * (i % 3), 1)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    return df.select("id", "x", array_to_vector("x").alias("features")).cache()


def test_labels_are_the_nearest_centre(blobs):
    model = cluster.fit_kmeans(blobs, k=3)
    labelled = cluster.assign(model, blobs, ["id", "x"])
    centres = np.array(model.clusterCenters())
    for r in labelled.collect():
        assert r["cluster"] == int(np.argmin(((centres - np.array(r["x"])) ** 2).sum(axis=1)))
    assert sorted(r["count"] for r in cluster.cluster_sizes(labelled).collect()) == [200, 200, 200]


def test_sweep_cost_falls(blobs):
    rows = cluster.sweep_k(blobs, ks=[2, 3, 4]).orderBy("k").collect()
    assert rows[0]["cost"] > rows[1]["cost"] > rows[2]["cost"]
    assert max(rows, key=lambda r: r["silhouette"])["k"] == 3


def test_embedding_is_the_mean_of_token_vectors(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")] * 20, "K string, L string")
    tokens = encode.tokenise(encode.category_document(df, ["K", "L"]))
    model = cluster.fit_embedding(tokens)
    words = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    row = model.transform(tokens).filter("K = 'a'").first()
    assert len(row["category_vec"]) == 20
    assert np.allclose(row["category_vec"].toArray(), (words["k_a"] + words["l_x"]) / 2, atol=1e-6)


def test_dominant_tie_takes_the_smallest_label(spark, rows):
    df = spark.createDataFrame([("A", 2), ("A", 1), ("B", 0), ("B", 3), ("B", 3)], "place string, cluster int")
    assert rows(cluster.dominant_cluster(df, ["place"])) == [("A", 1, 1), ("B", 3, 2)]


def test_locations_and_box(spark, rows):
    places = spark.createDataFrame(
        [("A", 30.0, -100.0), ("B", 20.0, -90.0), ("C", 40.0, -60.0), ("D", None, None), ("E", 49.9, -129.9)],
        "IATA_CODE string, LATITUDE double, LONGITUDE double",
    )
    dominant = spark.createDataFrame(
        [(a, b, 1, 5) for a, b in [("A", "E"), ("A", "B"), ("C", "A"), ("A", "D"), ("A", "Z"), ("E", "A")]],
        "o string, d string, cluster int, count long",
    )
    located = cluster.locate_routes(dominant, "o", "d", places, "iata_code", "latitude", "longitude")
    assert rows(located, "o", "d") == [("A", "E"), ("E", "A")]
    single = spark.createDataFrame([("A", 1, 1), ("Z", 0, 1)], "p string, cluster int, count long")
    assert rows(cluster.locate_keys(single, "p", places, "IATA_Code", "LATITUDE", "LONGITUDE")) == [
        ("A", 1, 30.0, -100.0), ("Z", 0, None, None)
    ]


def test_frequent_routes(spark):
    routes = spark.createDataFrame([(f"r{i}", i) for i in range(1, 12)], "r string, count long")
    assert sorted(r["count"] for r in cluster.frequent_routes(routes).collect()) == [10, 11]


def test_top_values_and_means(spark, rows):
    df = spark.createDataFrame([(0, "b", 1.0), (0, "a", 3.0), (0, "c", 5.0), (0, "c", 7.0), (1, "a", None)], "cluster int, v string, n double")
    assert rows(cluster.cluster_top_values(df, "v", 2)) == [(0, "a", 1, 25.0, 2), (0, "c", 2, 50.0, 1), (1, "a", 1, 100.0, 1)]
    assert rows(cluster.category_means(df, ["v"], ["n"])) == [
        ("v", "a", "n", 3.0), ("v", "b", "n", 1.0), ("v", "c", "n", 6.0)
    ]
    assert rows(cluster.cluster_value_share(df.filter("cluster = 0"), "v")) == [(0, "a", 1, 25.0), (0, "b", 1, 25.0), (0, "c", 2, 50.0)]


def test_silhouette_of_given_labels(blobs):
    labelled = blobs.withColumn("cluster", F.col("id") % 3)
    assert cluster.silhouette(labelled) > 0.9
