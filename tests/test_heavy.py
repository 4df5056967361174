"""The most frequent values against a plain count, where the bound decides and where it does not."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctual.operators import heavy


def plain(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one value; 20 more are frequent, the others are met once."""
    rng = random.Random(3)
    values = [-1] * 4000 + [v for v in range(20) for _ in range(50 + v)] + list(range(1000, 7000))
    rng.shuffle(values)
    return values, spark.createDataFrame([(v,) for v in values], "v long").repartition(5).cache()


@pytest.mark.parametrize("k", [1, 5, 21])
def test_bound_decides(skewed, k):
    values, df = skewed
    assert [tuple(r) for r in heavy.top_values(df, ["v"], k).collect()] == plain(values, k)
    counters = heavy.slot_counts(df, ["v"])
    least = heavy.reached(df, ["v"], k, counters)
    rows = heavy.rows_in(df, ["v"], counters.filter(F.col("n") >= least)).count()
    assert least == plain(values, k)[-1][1]
    assert rows < len(values) - 5500  # what is met once stays where it is


@pytest.mark.parametrize("slots", [1, 8, 64, heavy.SLOTS])
def test_bound_fails(spark, skewed, slots):
    """Few slots, or even counts: the bound passes most rows, and the result is the same."""
    values, df = skewed
    assert [tuple(r) for r in heavy.top_values(df, ["v"], 22, slots).collect()] == plain(values, 22)
    even = [i % 500 for i in range(3000)]
    frame = spark.createDataFrame([(v,) for v in even], "v long").repartition(3)
    assert [tuple(r) for r in heavy.top_values(frame, ["v"], 7, slots).collect()] == plain(even, 7)
    counters = heavy.slot_counts(frame, ["v"], slots)
    least = heavy.reached(frame, ["v"], 7, counters, slots)
    assert heavy.rows_in(frame, ["v"], counters.filter(F.col("n") >= least), slots).count() == 3000


def test_counters_of_parts_add_up(skewed):
    values, df = skewed
    parts = heavy.slot_counts(df.filter("v < 10"), ["v"]).unionByName(heavy.slot_counts(df.filter("v >= 10"), ["v"]))
    whole = sorted(map(tuple, heavy.slot_counts(df, ["v"]).collect()))
    assert sorted(map(tuple, heavy.added(parts).collect())) == whole
    assert [tuple(r) for r in heavy.top_values(df, ["v"], 3, counters=heavy.added(parts)).collect()] == plain(values, 3)


def test_odd_tables(spark):
    schema = "a string, b int"
    rows = [("x", 1)] * 3 + [(None, 1)] * 4 + [("x", None)] * 2 + [(None, None)]
    df = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in heavy.top_values(df, ["a", "b"], 2).collect()] == [(None, 1, 4), ("x", 1, 3)]
    assert heavy.top_values(df, ["a", "b"], 50).count() == 4
    assert heavy.top_values(spark.createDataFrame([], schema), ["a"], 3).count() == 0


def test_only_candidates_are_shuffled(skewed):
    """The plan counts by value behind the two semi joins."""
    _, df = skewed
    plan = heavy.top_values(df, ["v"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == heavy.LINES and plan.index("Aggregate") < plan.index("LeftSemi")
