import math
import random

import numpy as np
import pytest

from punctual.operators import outliers
from punctual.operators.quantiles import disc_rank, quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.975, 1.0]


def disc(values, p):
    return sorted(values)[disc_rank(p, len(values)) - 1]


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(5)
    return {
        "uniform": [rng.random() for _ in range(60_000)],
        # One value holds a third of the rows.
        "hot": [0.0 if rng.random() < 0.34 else rng.gauss(0, 3) for _ in range(60_000)],
        "few": [float(rng.randrange(5)) for _ in range(60_000)],
        "tailed": [math.exp(rng.gauss(0, 4)) for _ in range(60_000)],
        "equal": [7.0] * 60_000,
    }


@pytest.mark.parametrize("interior", [200_000, 50])
def test_exact_quantiles(spark, samples, interior):
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*samples.values())], list(samples)).repartition(5).cache()
    exact = quantiles(df, {c: PROBS for c in samples}, interior_rows=interior)
    smooth = quantiles(df, {c: PROBS for c in samples}, interpolate=True, interior_rows=interior)
    for c, values in samples.items():
        for p in PROBS:
            assert exact[c, p] == disc(values, p), (c, p)
            assert smooth[c, p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12), (c, p)


def test_integers_ties_nulls_and_empty(spark):
    rows = [(i, None, float("nan") if i % 2 else float(i)) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    got = quantiles(df, {"a": [0.5, 0.975], "b": [0.5], "c": [0.5]})
    assert got == {("a", 0.5): 50, ("a", 0.975): 98, ("b", 0.5): None, ("c", 0.5): 50.0}


def test_single_row(spark):
    df = spark.createDataFrame([(3.0,)], "a double")
    assert quantiles(df, {"a": [0.1, 0.9]}, interpolate=True) == {("a", 0.1): 3.0, ("a", 0.9): 3.0}


def test_sketch_is_within_its_error(spark, samples):
    values = sorted(samples["uniform"])
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = quantiles(df, {"a": [0.5]}, relative_error=0.01)["a", 0.5]
    assert abs(np.searchsorted(values, got) / len(values) - 0.5) <= 0.011


def test_cap_keeps_nulls_and_fits_elsewhere(spark, rows):
    df = spark.createDataFrame([(1,), (50,), (100,), (None,)], "a int")
    assert rows(outliers.cap_above(df, "a", 60)) == [(1,), (50,), (60,), (None,)]
    threshold = outliers.fit_cap(spark.range(1, 101), "id", 0.975)
    assert threshold == 98


def test_box_stats_match_numpy(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(500)] + [40.0, -40.0]
    row = outliers.box_stats(spark.createDataFrame([(v,) for v in values], "a double")).first()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, q2, q3))
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (min(inside), max(inside), len(values) - len(inside))


def test_ranks_are_rounded_up_at_any_size():
    from punctual.operators.quantiles import disc_rank

    assert disc_rank(0.5, 1_000_000_001) == 500_000_001
    assert disc_rank(0.25, 3_000_000_001) == 750_000_001
    assert disc_rank(0.9, 10 ** 12) == 9 * 10 ** 11
    assert disc_rank(0.1, 10) == 1
