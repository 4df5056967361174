"""Sums of products by task against numpy; the lasso against Spark's own."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from punctual.operators import assoc, gram, selection


def nullable(rng, v, share=0.15):
    return None if rng.random() < share else v


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        a = rng.gauss(1e6, 1)  # large against its spread
        g = nullable(rng, i % 3, 0.05)
        rows.append((g, i, nullable(rng, a), nullable(rng, 2 * a + rng.gauss(0, 1)), nullable(rng, rng.gauss(0, 1)), 7, a + rng.gauss(0, 0.1)))
    return spark.createDataFrame(rows, "g int, i int, a double, b double, c double, flat int, full double").repartition(4).cache()


@pytest.mark.parametrize("held", [20_000_000, 1])
def test_pairs_equal_numpy(table, monkeypatch, held):
    monkeypatch.setattr(gram, "HELD_NUMBERS", held)
    columns = ["a", "b", "c", "flat", "full"]
    rows = table.collect()
    got = gram.gram(table, columns, ["g"]).collect()
    assert len(got) == 4 * 15
    for r in got:
        x, y = columns[r["_i"]], columns[r["_j"]]
        both = np.array([(t[x], t[y]) for t in rows if t["g"] == r["g"] and t[x] is not None and t[y] is not None], float)
        assert r["n"] == len(both)
        assert r["mean_x"] == pytest.approx(both[:, 0].mean(), rel=1e-13) and r["mean_y"] == pytest.approx(both[:, 1].mean(), rel=1e-13)
        cov = np.cov(both.T, bias=True)
        assert (r["cxx"], r["cyy"], r["cxy"]) == pytest.approx((cov[0, 0], cov[1, 1], cov[0, 1]), rel=1e-7, abs=1e-9)
        assert r["varies"] == (x != "flat" and y != "flat")


def test_not_a_number_stays_in_its_pairs(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 5.0, 3.0), (nan, 1.0, None), (4.0, 4.0, 2.0)], "a double, b double, c double")
    got = {(r["row_feature"], r["column_feature"]): r["correlation"] for r in assoc.pearson_long(df, ["a", "b", "c"]).collect()}
    assert math.isnan(got["a", "b"]) and math.isnan(got["a", "a"]) and got["b", "b"] == 1
    assert got["a", "c"] == pytest.approx(np.corrcoef([1, 2, 4], [1, 3, 2])[0, 1])


def test_empty_table_and_clashing_names(spark, table):
    names = {"a": "_i", "b": "_j", "c": "n"}
    assert gram.gram(table.limit(0), ["a", "b"], ["g"]).collect() == []
    clash = table.select("g", *[F.col(k).alias(v) for k, v in names.items()])
    got = {tuple(r)[:2]: r for r in assoc.pearson_long(clash, list(names.values())).collect()}
    want = {(r[0], r[1]): r[2] for r in assoc.pearson_long(table, list(names)).collect()}
    assert {(names[x], names[y]): v for (x, y), v in want.items()} == pytest.approx({k: r[2] for k, r in got.items()})


def test_plan_has_no_pairs_of_rows(table):
    plan = assoc.pearson_long(table, ["a", "b", "c", "full"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("MapInArrow")  # of the sums, both ways round


def shuffles(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_ranks_take_as_many_joins_for_any_number_of_columns(table):
    two, four = (assoc.average_ranks(table.dropna(), c, broadcast_rows=10) for c in (["a", "c"], ["a", "b", "c", "full"]))
    assert shuffles(two) == shuffles(four)


@pytest.mark.parametrize("penalty", [0.01, 0.3, 1.0])
def test_lasso_equals_the_library(spark, penalty):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 6)) * [1, 3, 0.2, 10, 1, 1] + [0, 5, 0, 100, 0, 0]
    x[:, 4] = x[:, 0] + rng.normal(size=600) * 0.2
    x[:, 5] = 3.0
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=600)
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([(0, *map(float, r), float(v)) for r, v in zip(x, y)], "cluster int, " + ", ".join(f"{n} double" for n in names) + ", y double")
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    fit = LinearRegression(labelCol="y", elasticNetParam=1.0, regParam=penalty, tol=1e-12, maxIter=2000).fit(vectors)
    mine = selection.lasso_coefficients(df, names, "y", regParam=penalty)[0]
    assert [mine[n] for n in names] == pytest.approx(list(fit.coefficients), abs=1e-5)
    conditions = selection.lasso_conditions(df, names, "y", regParam=penalty).collect()
    assert len(conditions) == 6 and all(r.optimal for r in conditions)
