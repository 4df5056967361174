"""Repeated rows against plain grouping, and what their plans shuffle."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctual.operators import repeats


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    kinds = [None, "", "a", "b" * 40]
    rows = [(rng.randrange(40), rng.choice(kinds), rng.choice([0.0, 1.5, None]), rng.choice([None, rng.randrange(9)])) for _ in range(500)]
    rows += [(1, "hot", 2.5, 3)] * 300 + [(i, f"single {i}", float(i), i) for i in range(1000, 1200)]
    return spark.createDataFrame(rows, "i int, text string, x double, n int").repartition(4).cache()


def told(rows, columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


@pytest.mark.parametrize("max_rows", [500_000, 3])
@pytest.mark.parametrize("columns", [["i", "text", "x", "n"], ["text", "n"], ["i"]])
def test_groups_equal_plain_grouping(table, columns, max_rows):
    want = {k: n for k, n in told(table.collect(), columns).items() if n > 1}
    got = {tuple(r[c] for c in columns): r["count"] for r in repeats.groups(table, columns, max_rows=max_rows).collect()}
    assert got == want


@pytest.mark.parametrize("max_rows", [500_000, 3])
def test_rows_of_repeated_keys(table, max_rows):
    all_rows = [tuple(r) for r in table.collect()]
    n = told(table.collect(), ["text", "n"])
    want = Counter(r for r in all_rows if r[1] is not None and r[3] is not None and n[r[1], r[3]] > 1)
    assert Counter(tuple(r) for r in repeats.rows(table, ["text", "n"], max_rows).collect()) == want


def test_a_null_is_not_the_next_value(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None), ("1", None)], "a string, b string")
    assert [tuple(r) for r in repeats.groups(df).collect()] == [("1", None, 2)]


def test_zero_nan_and_clashing_names(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.0, "t" * 40), (-0.0, "t" * 40), (nan, "u"), (nan, "u"), (1.0, "u")], "_n double, `count` string")
    got = sorted(r["size"] for r in repeats.groups(df, count="size").collect())
    assert got == [2, 2] and repeats.groups(df.limit(0), count="size").count() == 0


def test_single_rows_are_not_shuffled(table):
    found = repeats.candidates(table, ["i", "text", "x", "n"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert found.count() < table.count() - 150
