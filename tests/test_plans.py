import pytest
from pyspark.sql import functions as F

from punctual.catalog.frames import LINE_KEY, movements, place_pairs
from punctual.operators import regress
from punctual.plans import cluster_splits, edge_table, filter_complete, prepare_regression, prepare_splits, select_features
from punctual.plans.columns import CLUSTER_TARGETS, FREQUENCY


@pytest.fixture(scope="module")
def flights(spark, sf_dir):
    # The line key is unique on the larger tables only.
    return filter_complete(movements(spark, sf_dir)).dropDuplicates(LINE_KEY).cache()


@pytest.fixture(scope="module")
def prepared(spark, sf_dir, flights):
    return prepare_splits(flights, place_pairs(spark, sf_dir), LINE_KEY, 0.9)


def test_splits_are_disjoint_and_share_a_schema(prepared):
    frames = prepared.frames
    assert set(frames) == {"train", "val", "test"}
    assert len({tuple(df.dtypes) for df in frames.values()}) == 1
    sizes = {n: df.count() for n, df in frames.items()}
    assert sizes["train"] > 3 * sizes["val"] and abs(sizes["val"] - sizes["test"]) < 0.2 * sizes["val"]
    keys = frames["train"].select(*LINE_KEY).union(frames["val"].select(*LINE_KEY)).union(frames["test"].select(*LINE_KEY))
    assert keys.distinct().count() == sum(sizes.values())
    for df in frames.values():
        assert df.filter(" or ".join(f"{c}_freq is null" for c in FREQUENCY if c != "TAIL_NUMBER")).count() == 0
        assert df.agg(F.max("DISTANCE")).first()[0] <= prepared.cap
        assert df.filter("ORIGIN_AIRPORT rlike '^[0-9]'").count() == 0


def test_preparation_does_not_depend_on_the_layout(spark, sf_dir, flights, prepared):
    again = prepare_splits(flights.repartition(7).orderBy(F.rand(1)), place_pairs(spark, sf_dir), LINE_KEY, 0.9)
    columns = ["index", *LINE_KEY, "DISTANCE", "ROUTE_freq"]
    for name, df in prepared.frames.items():
        left, right = df.select(*columns), again.frames[name].select(*columns)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_null_category_stays_unknown_in_training_only(spark, sf_dir, flights):
    holed = flights.withColumn("AIRLINE", F.when(F.col("l_suppkey") % 5 != 0, F.col("AIRLINE")))
    frames = prepare_splits(holed, place_pairs(spark, sf_dir), LINE_KEY, 0.9).frames
    assert frames["train"].filter("AIRLINE is null and AIRLINE_freq is not null").count() == 0
    assert frames["val"].filter("AIRLINE_freq is null").count() == 0


def test_edge_table_is_consistent(spark, sf_dir, flights):
    edges = edge_table(flights, place_pairs(spark, sf_dir), LINE_KEY, 0.9)
    assert edges.count() > 0
    assert edges.filter(
        "DEPARTURE_DELAY < 0 or DEPARTURE_TIME_min < SCHEDULED_DEPARTURE_min or WHEELS_ON > ARRIVAL_TIME "
        "or SCHEDULED_ARRIVAL_min < SCHEDULED_DEPARTURE_min"
    ).count() == 0
    assert not {"WHEELS_OFF", "TOTAL_KNOWN_DELAY", "SCHEDULED_DEPARTURE"} & set(edges.columns)


def test_clusters_then_regression(prepared):
    clustered = cluster_splits(prepared.frames, k=2)
    assert set(clustered.frames) == set(prepared.frames)
    for name, df in clustered.frames.items():
        assert not set(CLUSTER_TARGETS) & set(df.columns) and "category_vec" not in df.columns
        assert df.count() == prepared.frames[name].count() and df.filter("cluster not in (0, 1)").count() == 0
    labels = {n: df.select("index", "cluster") for n, df in clustered.frames.items()}
    frames, features = prepare_regression(prepared.frames, labels)
    assert set(frames["train"].columns) == {"cluster", "index", "ARRIVAL_DELAY", *features}
    chosen, votes = select_features(frames["train"], features, top=6, forest={"numTrees": 2, "maxDepth": 3})
    assert set(chosen) == {0, 1} and all("DEPARTURE_DELAY_scaled" in fs for fs in chosen.values())
    assert votes.filter("chosen = 1 and votes < 2").count() == 0
    models = regress.fit_per_cluster(frames["train"], chosen, "ARRIVAL_DELAY", "linear")
    scores = regress.score_per_cluster(models, frames, chosen, "ARRIVAL_DELAY").collect()
    assert len(scores) == 6 and min(r["r2"] for r in scores) > 0.8
