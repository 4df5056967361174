"""Ranks of columns of many values: both ways of looking them up, hot values, nulls, and how often the rows are ranked."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.operators import assoc, selection


@pytest.mark.parametrize("by_row", [4, 0])
@pytest.mark.parametrize("within", ["g", None])
def test_ranks_of_hot_and_missing_values(spark, monkeypatch, by_row, within):
    monkeypatch.setattr(assoc, "BY_ROW", by_row)
    rng = random.Random(3)
    rows = [(i % 3 if i % 11 else None, 7.0 if i % 2 else rng.random() if i % 7 else None, rng.choice([-0.0, 0.0, float("nan"), rng.random()]), i % 5) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, a double, b double, few int").repartition(3)
    got = assoc.average_ranks(df, ["a", "b", "few"], within=within, broadcast_rows=8).toPandas()
    assert len(got) == len(rows)
    for c in ("a", "b", "few"):
        for g in ([None] if within is None else [0, 1, 2]):
            part = sorted((tuple(r) for r in df.filter(F.lit(True) if g is None else F.col("g") == g).select(c).collect()), key=str)
            values = [r[0] for r in part if r[0] is not None]
            order = sorted((float("inf") if v != v else v) for v in values)
            want = sorted(order.index(float("inf") if v != v else v) + (order.count(float("inf") if v != v else v) + 1) / 2 for v in values)
            of = got if g is None else got[got.g == g]
            assert sorted(of[f"{c}_rank"].dropna()) == pytest.approx(want)
    if within:
        assert got[got.g.isna()][["a_rank", "b_rank", "few_rank"]].isna().all(axis=None)


def test_rows_are_ranked_once(spark):
    df = spark.createDataFrame([(i % 2, float(np.sin(i)), float(i % 5)) for i in range(200)], "cluster int, a double, y double")
    for told in (assoc.spearman_long(df, ["a", "y"]), selection.spearman_ranking(df, ["a"], "y")):
        plan = told._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "MapInArrow" not in plan  # the correlations are read, not made again by every reader
