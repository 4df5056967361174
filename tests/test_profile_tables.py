import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from punctual.operators import coherence, features, profile, tables

NAN = float("nan")


@pytest.fixture(scope="module")
def holes(spark):
    v = Vectors.dense([1.0])
    rows = [(1, None, NAN, "x", v), (2, None, 0.0, None, None), (3, None, -1.0, "y", v), (4, None, None, "y", v)]
    df = spark.createDataFrame(
        [(a, c, d, e) for a, _, c, d, e in rows], ["full", "num", "text", "vec"]
    )
    return df.withColumn("empty", F.lit(None).cast("int"))


def test_missing_profiles(holes, rows):
    got = {r["column"]: r["missing_percent"] for r in profile.missing_profile(holes).collect()}
    assert got == {"full": 0.0, "num": 25.0, "text": 25.0, "vec": 25.0, "empty": 100.0}
    assert profile.missing_profile(holes).first()["column"] == "empty"
    other = {r["column"]: r["missing_percent"] for r in profile.missing_profile(holes, denominator=8).collect()}
    assert other["empty"] == 50.0
    typed = {r["column"]: (r["kind"], r["missing_count"]) for r in profile.typed_missing(holes).collect()}
    assert typed == {
        "full": ("numeric", 0), "num": ("numeric", 2), "text": ("string", 1), "vec": ("vector", 1), "empty": ("numeric", 4)
    }


def test_zero_negative_and_counts(holes):
    got = {r["column"]: tuple(r)[1:] for r in profile.zero_negative_profile(holes, ["full", "num", "empty"]).collect()}
    assert got == {"full": (False, False, 0, 0), "num": (True, True, 1, 1), "empty": (False, False, 0, 0)}
    distinct = {r[0]: r[1] for r in profile.distinct_counts(holes, ["full", "text", "empty"], batch=2).collect()}
    assert distinct == {"full": 4, "text": 2, "empty": 0}
    near = {r[0]: r[1] for r in profile.distinct_counts(holes, ["full", "text"], approximate=True).collect()}
    assert near == {"full": 4, "text": 2}


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(profile.duplicate_groups(df)) == [(1, "a", 2), (None, "c", 2)]
    assert rows(profile.duplicate_groups(df, ["k"])) == [(1, 3), (None, 2)]


def test_retention_and_uniqueness(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 2), (3, None)], "i int, c int")
    assert rows(profile.retention(df, profile.all_present(["c", "c"]))) == [(4, 2, 2, 50.0)]
    assert rows(profile.index_uniqueness(df, "i")) == [(4, 3, False)]
    split = df.withColumn("s", F.col("i") > 2)
    assert rows(profile.index_uniqueness(split, "i", "s")) == [(False, 3, 2, False), (True, 1, 1, True)]


def test_schema_parity(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("x", F.lit("1"))
    got = {(r["column"], r["dtype"]): r["in_all"] for r in profile.schema_parity({"a": a, "b": b}).collect()}
    assert got == {("id", "bigint"): True, ("x", "int"): False, ("x", "string"): False}
    with pytest.raises(ValueError, match="b differs"):
        profile.validate_schema({"a": a, "b": b})
    profile.validate_schema({"a": a, "c": a})


def test_ties_are_broken_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in tables.top_groups(df, ["k"], 2).collect()] == [("c", 2), ("a", 1)]
    counts = spark.createDataFrame([("g", "x", 2), ("h", "y", 2), ("h", "z", 1)], "g string, v string, count long")
    assert [r[0] for r in tables.top_values_overall(counts, "v", 1).collect()] == ["x"]


def test_share_inside_group_uses_kept_values(spark, rows):
    df = spark.createDataFrame([(0, "a")] * 3 + [(0, "b")] + [(1, "a")] + [(1, "z")], "g int, v string")
    assert rows(tables.share_inside_group(df, "g", "v", 2)) == [(0, "a", 3, 0.75), (0, "b", 1, 0.25), (1, "a", 1, 1.0)]


def test_pivot_fill_has_the_cell_type(spark, rows):
    df = spark.createDataFrame([("f", 0, 1.5), ("g", 1, 2.5)], "feature string, cluster int, w float")
    wide = tables.pivot_first(df, "feature", "cluster", "w", [0, 1, 2], fill=F.lit(0), prefix="c")
    assert rows(wide) == [("f", 1.5, 0.0, 0.0), ("g", 0.0, 2.5, 0.0)]
    assert dict(wide.dtypes)["c2"] == "float"


def test_features(spark, rows):
    df = spark.createDataFrame([(15, None, None), (16, 1, None), (None, 1, 2)], "delay int, a int, b int")
    got = features.with_known_delay(features.with_delay_flag(df, "delay"), ["a", "b"])
    assert [tuple(r) for r in got.collect()] == [(15, None, None, 0, 0), (16, 1, None, 1, 1), (None, 1, 2, None, 3)]
    crossing = spark.createDataFrame([(1400, 39), (1400, 40), (None, 1)], "start int, air int")
    flags = features.with_midnight_flag(crossing, "start", "air", "f", total="t").select("f", "t").collect()
    assert [tuple(r) for r in flags] == [(0, 1439), (1, 1440), (None, None)]


def test_clock_wraps_both_ways(spark):
    df = spark.createDataFrame([(5, -10, 1435), (1430, 30, 20), (60, 0, 60), (60, 0, 120)], "s int, d int, a int")
    got = coherence.clock_difference(df, "s", "d", "a")
    assert [r["difference"] for r in got.collect()] == [0, 0, 0, -60]
    assert coherence.mismatch_summary(got).first().asDict() == {"mismatches": 1, "total": 4}
    assert [tuple(r) for r in coherence.difference_histogram(got).collect()] == [(-60, 1)]
    assert coherence.worst_first(got, "difference", ["s"], 1).first()["difference"] == -60


def test_zero_causes(spark, rows):
    df = spark.createDataFrame([(0, 0, 1, 2), (0, 0, 1, 1), (0, None, 1, 2), (1, 0, 1, 2)], "a int, b int, s int, t int")
    assert rows(coherence.zero_cause_conflicts(df, ["a", "b"], [("s", "t")])) == [(0, 0, 1, 2)]


def test_early_values(spark, rows):
    df = spark.createDataFrame([(-11,), (-10,), (-1,), (0,), (None,), (-1,)], "d int")
    assert rows(coherence.early_values(df, "d", [])) == [(-1,), (-10,), (-11,)]
    assert coherence.early_count(df, "d", -10).first()[0] == 1


def test_time_order_rules(spark):
    # id, flag, departure, off, on, arrival, scheduled departure, scheduled arrival
    cases = [
        (0, 0, 10, 20, 30, 40, 1, 2), (1, 0, 20, 10, 30, 40, 1, 2), (2, 1, 20, 10, 30, 40, 1, 2),
        (3, 1, 10, 40, 30, 50, 1, 2), (4, 0, 10, 20, 30, 25, 1, 2), (5, 1, 10, 20, 30, 40, 3, 2),
        (6, 0, 10, None, 30, 40, 1, 2), (7, 1, 10, 20, None, 40, 1, 2),
    ]
    df = spark.createDataFrame(cases, "id int, flag int, dep int, off int, land int, arr int, sd int, sa int")
    kept = coherence.time_order(df, "flag", ("dep", "off"), [("off", "land"), ("land", "arr"), ("sd", "sa")])
    assert sorted(r["id"] for r in kept.collect()) == [0, 2]
    early = spark.createDataFrame([(-1, 9, 5), (0, 5, 5), (3, 4, 5)], "d int, a int, s int")
    assert [tuple(r) for r in coherence.drop_early_departures(early, "d", "a", "s").collect()] == [(0, 5, 5)]


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert {r["missing_percent"] for r in profile.missing_profile(empty).collect()} == {None}
    assert profile.retention(empty, F.col("a") > 0).first()["dropped_percent"] is None
    assert profile.stratum_share(empty, ["b"]).count() == 0
    assert tables.top_groups(empty, ["b"], 3).count() == 0
