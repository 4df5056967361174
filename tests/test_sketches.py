"""Quantile sketches: ranks near those asked for, whole or merged; odd values."""

import random

import pytest
from pyspark.sql import functions as F

from punctual.operators import sketches

PS = [0.0, 0.01, 0.5, 0.95, 1.0]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(i % 7, "a" if i % 3 else "b", 0.0 if rng.random() < 0.35 else rng.gauss(0, 1) ** 3, rng.randrange(50)) for i in range(20_000)]
    rows += [(0, "a", None, None), (0, "a", float("nan"), 1), (1, "empty", None, None)]
    return spark.createDataFrame(rows, "day int, g string, x double, n int").repartition(6).cache()


def test_merged_sketches_are_as_near_as_whole_ones(table):
    by_day = sketches.quantile_sketches(table, ["x", "n"], ["g", "day"])
    whole = sketches.quantile_sketches(table, ["x", "n"], ["g"])
    for found in (whole, sketches.merged(by_day, ["g"])):
        errors = sketches.rank_errors(table, sketches.sketched_quantiles(found, PS, ["g"]), ["x", "n"], ["g"]).collect()
        assert len(errors) == 2 * 2 * len(PS) and max(r["error"] for r in errors) <= sketches.RANK_ERROR
        assert {(r["g"], r["column"]): r["rows"] for r in found.collect()} == {(r["g"], r["column"]): r["rows"] for r in errors}


def test_smallest_and_greatest_are_exact(table):
    found = sketches.sketched_quantiles(sketches.merged(sketches.quantile_sketches(table, ["n"], ["day"])), [0.0, 1.0]).collect()
    assert {r["p"]: r["value"] for r in found} == {0.0: 0.0, 1.0: 49.0}


def test_groups_without_values_have_no_sketch(table):
    found = sketches.quantile_sketches(table.filter("g = 'empty'"), ["x", "n"], ["g"])
    assert found.count() == 0 and sketches.sketched_quantiles(sketches.merged(found, ["g"]), PS, ["g"]).count() == 0
    assert sketches.rank_errors(table, sketches.sketched_quantiles(found, PS, ["g"]), ["x"], ["g"]).filter(F.col("error") >= 0).count() == 0
