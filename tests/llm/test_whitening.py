"""Operator 11 against the eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import whitening
from punctual.llm.queries import QUERIES


def brute(rows):
    kept = [(i, [math.floor(64.0 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[n * x[j] - sums[j] for j in range(d)] for x in fit], dtype=object)
    v = np.array([[float(Fraction(int(a), n ** 3)) for a in row] for row in centred.T.dot(centred)])
    values, vectors = np.linalg.eigh(v)
    deviations = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept]
    rows_at = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in kept])
    return n, deviations, values[::-1], vectors[:, ::-1], rows_at


def check(rows, got, components=16):
    n, deviations, values, vectors, centred = brute(rows)
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    by_component = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, k + 1))
    for c, told in by_component.items():
        assert sorted(((r.vec_id, r.deviation) for r in told), key=str) == sorted(deviations, key=str)
        assert told[0].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        want = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        mine = np.array([w for _, w in sorted((r.vec_id, r.whitened) for r in told)])
        other = np.array([w for _, w in sorted(zip([i for i, _ in deviations], want))])
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-6


def test_query_on_a_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op11_lanczos_whitening"](spark, sf_dir).collect()
    assert len(got) == 16 * len(rows)
    check(rows, got)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_odd_rows_and_clashing_columns(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in random.normal(0, (3, 2, 1, .5), 4)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 2.0, 3.0]), (62, [1.0, float("nan"), 0.0, 0.0]), (63, [float("inf")] + [0.0] * 3), (None, rows[0][1]), (5, rows[5][1])]
    rows += [(70 + i, rows[7][1]) for i in range(30)]
    docs = _frame(spark, rows)
    for name in ("x", "v", "component", "n", "whitened"):
        docs = docs.withColumn(name, F.lit("no"))
    got = whitening.whiten(docs).collect()
    n, deviations, *_ = brute(rows)
    assert n == 60 and len(got) == 4 * len(deviations)
    short = whitening.whiten(_frame(spark, [*rows, (99, [1.0, 2.0]), (98, [])])).collect()
    assert len(short) == len(got) and {r.vec_id for r in short} == {r.vec_id for r in got}
    unique = [r for i, r in enumerate(rows) if i < 60]
    check(unique, whitening.whiten(_frame(spark, unique)).collect())


def test_ranks_below_the_dimension(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    check(line, whitening.whiten(_frame(spark, line)).collect())
    # equal deviations in all directions: a cube's corners
    cube = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1)]) for i in range(8)]
    got = whitening.whiten(_frame(spark, cube)).collect()
    assert {r.component for r in got} == {1, 2, 3} and max(r.identity_error for r in got) < 1e-9
    assert all(r.explained == pytest.approx(1 / 3) for r in got)


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(_frame(spark, rows)).collect() == []


def test_bidiagonal_form_and_great_entries(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(40, 6))
    v, b = whitening.bidiagonalise(lambda p: (x.T @ (x @ p), float(np.square(x @ p).sum())), 6)
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-13) and np.allclose(np.triu(np.tril(b, 1)), b)
    assert np.allclose(np.linalg.svd(b)[1], np.linalg.svd(x)[1], rtol=1e-12)
    great = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    got = whitening.whiten(_frame(spark, great)).collect()
    assert {r.deviation for r in got if r.vec_id == 1} == {None} and {r.vec_id for r in got} == {1, 2, 3}
