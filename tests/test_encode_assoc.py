import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctual.operators import assoc, encode


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        a = rng.gauss(0, 1)
        b = 0.0 if rng.random() < 0.4 else float(rng.randrange(6))  # a hot value
        rows.append((i % 3, a, b, a**3 + rng.random() / 100, 5.0))
    return spark.createDataFrame(rows, "g int, a double, b double, c double, flat double").repartition(5).cache()


def matrix(long, digits=9):
    return {(r["row_feature"], r["column_feature"]): r["correlation"] for r in long.collect()}


def test_one_hot_order_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "k string")
    model = encode.fit_one_hot(train, ["k"])
    out = model.transform(spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "k string"))
    assert encode.slot_count(out, "k_vec") == 3
    assert encode.slot_names(out, "k_vec") == ["b", "a", "c"]
    wide = encode.vector_columns(out, "k_vec", ["s0", "s1", "s2"]).select("s0", "s1", "s2")
    assert [tuple(r) for r in wide.collect()] == [(0, 1, 0), (1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_scaler_constant_and_fit_on_train(spark, numbers):
    model = encode.fit_scaler(numbers, ["a", "flat"])
    scaled = encode.scaled_columns(numbers, model, ["a", "flat"])
    stats = scaled.agg(F.avg("a_scaled"), F.stddev("a_scaled"), F.max(F.abs("flat_scaled"))).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1) and stats[2] == 0
    other = spark.createDataFrame([(100.0, 5.0)], "a double, flat double")
    assert encode.scaled_columns(other, model, ["a", "flat"]).first()["a_scaled"] > 50


def test_frequencies(spark, rows):
    train = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3), ("c", 3), (None, 3)], "k string, n int")
    single = encode.frequency_table(train, "k")
    models = encode.fit_frequencies(train, ["k", "n"])
    assert rows(models["k"].table) == rows(single)
    assert rows(models["n"].table) == [(1, 0.333333), (2, 0.166667), (3, 0.5)]
    assert models["k"].fill == encode.unseen_fill(single, "k") == 0.166667
    assert models["n"].fill == 0.333333
    other = spark.createDataFrame([("a",), ("new",), (None,)], "k string")
    assert rows(encode.apply_frequencies(other, models["k"])) == [("a", 0.5), ("new", 0.166667), (None, 0.166667)]
    assert rows(encode.apply_frequencies(other, single, "k")) == [("a", 0.5), ("new", None), (None, None)]
    assert rows(encode.row_medians(encode.apply_frequencies(train, single, "k"), ["k_freq"])) == [("k_freq", 0.5)]


def test_unseen_values(spark):
    train = spark.createDataFrame([("a",)], "k string")
    other = spark.createDataFrame([("a",), ("y",), ("x",), ("z",), ("z",)], "k string")
    got = [tuple(r) for r in encode.unseen_values(other, train, "k", 2).collect()]
    assert got == [("z", 2, 0.4), ("x", 1, 0.2)]


def test_documents_and_tokens(spark):
    df = spark.createDataFrame([("UA", "Early Morning"), (None, "Night")], "AIR string, PERIOD string")
    tokens = encode.tokenise(encode.category_document(df, ["AIR", "PERIOD"]))
    assert [r["category_doc"] for r in tokens.collect()] == ["AIR_UA PERIOD_Early Morning", "AIR PERIOD_Night"]
    assert tokens.first()["tokens"] == ["air_ua", "period_early", "morning"]
    assert tokens.first()["AIR"] == "UA"


def test_pearson_equals_pandas(numbers):
    columns = ["a", "b", "c"]
    expected = numbers.toPandas()[columns].corr()
    for long in (assoc.pearson_long(numbers, columns), assoc.pearson_matrix(numbers, columns)):
        got = matrix(long)
        assert len(got) == 9
        for pair, value in got.items():
            assert value == pytest.approx(expected.loc[pair], abs=1e-9)


def test_pearson_drops_nulls_per_pair(spark):
    pdf = pd.DataFrame({"x": [1, 2, None, 4, 7.0], "y": [2, None, 3, 9, 1.0], "z": [1, 2, 3, 4, 6.0]})
    df = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in pdf.itertuples(index=False)], list("xyz"))
    expected = pdf.corr()
    for pair, value in matrix(assoc.pearson_long(df, list("xyz"))).items():
        assert value == pytest.approx(expected.loc[pair])


@pytest.mark.parametrize("broadcast_rows", [500_000, 4])
def test_ranks_equal_pandas(numbers, broadcast_rows):
    ranked = assoc.average_ranks(numbers, ["a", "b"], broadcast_rows=broadcast_rows).toPandas()
    for c in ("a", "b"):
        assert np.allclose(ranked[c].rank(), ranked[f"{c}_rank"])
    grouped = assoc.average_ranks(numbers, ["b"], within="g", broadcast_rows=broadcast_rows).toPandas()
    assert np.allclose(grouped.groupby("g")["b"].rank(), grouped["b_rank"])


def test_spearman_equals_pandas(numbers):
    columns = ["a", "b", "c"]
    pdf = numbers.toPandas()
    for pair, value in matrix(assoc.spearman_long(numbers, columns)).items():
        assert value == pytest.approx(pdf[columns].corr("spearman").loc[pair], abs=1e-9)
    for r in assoc.spearman_long(numbers, columns, within="g").collect():
        expected = pdf[pdf.g == r["g"]][columns].corr("spearman").loc[r["row_feature"], r["column_feature"]]
        assert r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_pruning(spark, rows):
    long = spark.createDataFrame(
        [(a, b, v) for x, y, v in [("p", "q", 0.9), ("p", "r", -0.95), ("q", "r", 0.1), ("p", "t", 0.5), ("q", "t", -0.5),
                                   ("r", "t", 0.6), ("flat", "p", float("nan")), ("flat", "t", float("nan"))]
         for a, b in ((x, y), (y, x))],
        "row_feature string, column_feature string, correlation double",
    )
    features = ["p", "q", "r", "flat"]
    assert rows(assoc.high_pairs(long, features)) == [("p", "q", 0.9), ("p", "r", -0.95)]
    pruned = assoc.prune_pairs(long, features, "t")
    # A tie drops the second; otherwise the one that says less about the target goes.
    assert rows(pruned, "first", "second", "dropped") == [("p", "q", "q"), ("p", "r", "p")]
    assert assoc.kept_features(pruned, features) == ["r", "flat"]


def test_constant_columns_have_no_correlation(numbers):
    got = matrix(assoc.pearson_long(numbers, ["a", "flat"]))
    assert got["a", "flat"] is None and got["a", "a"] == pytest.approx(1)
    by_group = assoc.spearman_long(numbers, ["a", "flat"], within="g").filter("row_feature <> column_feature")
    assert {r["correlation"] for r in by_group.collect()} == {None}
