import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from punctual.functions import stable_hash
from punctual.operators import keys


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(1)
    # Stratum 1 holds most rows; one stratum is null; one has a single row.
    rows = [(i, rng.choice([1, 1, 1, 1, 2, 3, None]) if i else 9, rng.randrange(40)) for i in range(5000)]
    return spark.createDataFrame(rows, "id int, stratum int, v int")


def layouts(df):
    return [df.repartition(1), df.repartition(7), df.orderBy(F.rand(3))]


def direct_split(df):
    w = Window.partitionBy("stratum")
    ranked = df.withColumns(
        {"rn": F.row_number().over(w.orderBy(stable_hash("id"), "id")), "n": F.count(F.lit(1)).over(w)}
    )
    label = F.when(F.expr("rn * 100 <= n * 70"), "train").when(F.expr("rn * 100 <= n * 85"), "val").otherwise("test")
    return ranked.select("id", "stratum", "v", label.alias("split"))


def test_split_equals_ranking_on_every_layout(events, rows):
    expected = rows(direct_split(events))
    for df in layouts(events):
        assert rows(keys.stratified_split(df, "stratum", ["id"])) == expected


@pytest.mark.parametrize("bits", [1, 4, 20])
def test_split_bounds_hold_for_any_bucket_size(events, bits, rows):
    bounds = keys.split_bounds(events, "stratum", ["id"], [70, 85], bits)
    assert rows(bounds) == rows(keys.split_bounds(events, "stratum", ["id"], [70, 85]))


def test_split_other_shares(events):
    split = keys.stratified_split(events, "stratum", ["id"], {"a": 50, "b": 50})
    sizes = {r[0]: r[1] for r in split.filter("stratum = 1").groupBy("split").count().collect()}
    assert abs(sizes["a"] - sizes["b"]) <= 1


def test_split_does_not_shuffle_the_rows(events):
    plan = keys.stratified_split(events, "stratum", ["id"])._jdf.queryExecution().executedPlan().toString()
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in top and "Window" not in top


def test_index_is_dense_and_ordered(events, rows):
    expected = [
        (i, *r) for i, r in enumerate(sorted((tuple(r) for r in events.select("v", "id").collect())), start=1)
    ]
    for df in layouts(events.select("v", "id")):
        got = keys.global_index(df, ["v", "id"], partitions=6)
        assert sorted(map(tuple, got.collect())) == expected
        assert got.columns[0] == "index"


def test_index_within_groups(events):
    got = keys.global_index(events.fillna(0), ["v", "id"], within="stratum", partitions=6)
    seen = {}
    for r in sorted(got.collect(), key=lambda r: (r["stratum"], r["v"], r["id"])):
        seen[r["stratum"]] = seen.get(r["stratum"], 0) + 1
        assert r["index"] == seen[r["stratum"]]
    assert sum(seen.values()) == 5000


def test_index_has_no_single_partition_window_over_rows(events):
    plan = keys.global_index(events, ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]


def test_running_count_two_ways(spark, rows):
    rng = random.Random(2)
    counts = spark.createDataFrame(
        [(g, float(v), rng.randrange(1, 9)) for g in range(3) for v in range(200)], "g int, v double, n long"
    ).repartition(5)
    assert rows(keys.running_count(counts, "g", "v", "n", "b")) == rows(
        keys.running_count(counts, "g", "v", "n", "b", window_rows=10)
    )


def test_sample_and_limit_are_stable(events, rows):
    sample = rows(keys.stable_sample(events, ["id"], 0.2))
    assert 800 < len(sample) < 1200
    first = rows(keys.stable_limit(events, ["id"], 50))
    assert len(first) == 50
    for df in layouts(events):
        assert rows(keys.stable_sample(df, ["id"], 0.2)) == sample
        assert rows(keys.stable_limit(df, ["id"], 50)) == first


def test_index_and_running_count_keep_rows_of_null_and_empty_groups(spark):
    rows = [(g, i) for i, g in enumerate([None, "", "a", "b"] * 10)]
    df = spark.createDataFrame(rows, "g string, v int")
    indexed = keys.global_index(df, ["v"], within="g").collect()
    assert sorted((r.g is None, r.g or "", r["index"]) for r in indexed) == sorted(
        (g is None, g or "", k) for g in (None, "", "a", "b") for k in range(1, 11))
    counts = df.withColumn("n", F.lit(1))
    for window_rows in (1000, 5):
        got = keys.running_count(counts, "g", "v", "n", "before", window_rows=window_rows).collect()
        assert len(got) == 40
        assert all(r.before == r.v // 4 for r in got)


def test_rank_in_stratum_spreads_a_hot_stratum(spark):
    stratum = F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit(""))
    df = spark.range(300).withColumn("g", stratum).withColumn("v", F.pmod(F.col("id") * 7, F.lit(50)))
    ranked = keys.rank_in_stratum(df, ["g"], [F.col("v").desc(), "id"], "rank", "size")
    got = {r["id"]: (r["rank"], r["size"]) for r in ranked.collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append((-r["v"], r["id"]))
    want = {i: (n, len(rows)) for rows in groups.values() for n, (_, i) in enumerate(sorted(rows), 1)}
    assert got == want
    assert keys.rank_in_stratum(df.limit(0), ["g"], ["v", "id"], "rank", "size").count() == 0
