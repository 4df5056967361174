"""Sums of products of columns, for all pairs at once.

Every task keeps, for each group, matrices of sums over its rows and sends p (p + 1) / 2 numbers of each kind, however many rows
it has; equal groups of different tasks are added up. Values are taken from a point near their column's mean before they are
multiplied, so that sums of squares keep their digits when a mean is large against its spread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers a task holds at most before it sends what it has.
HELD_NUMBERS = 20_000_000
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_ENDS = ("min_x", "max_x", "min_y", "max_y")


@dataclass
class _Sums:
    """Matrices by (i, j): column i over the rows where column j is present too."""

    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    xy: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, shift: np.ndarray) -> _Sums:
        """``x`` holds NaN for a null; the caller has made a NaN that is a value an infinity, whose sums are undefined too."""
        there = ~np.isnan(x)
        m = there.astype(np.float64)
        z = np.where(there, x - shift, 0.0)
        p = x.shape[1]
        low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
        full = there.all(axis=0)
        ends = np.where(there, x, np.inf).min(axis=0), np.where(there, x, -np.inf).max(axis=0)
        for j in range(p):  # columns without a null share the ends of the whole block
            rows = x if full[j] else x[there[:, j]]
            if full[j]:
                low[:, j], high[:, j] = ends
            elif len(rows):
                low[:, j], high[:, j] = np.where(np.isnan(rows), np.inf, rows).min(axis=0), np.where(np.isnan(rows), -np.inf, rows).max(axis=0)
        if np.isfinite(z).all():
            return cls(m.T @ m, z.T @ m, np.square(z).T @ m, z.T @ z, low, high)
        sums = np.zeros((3, p, p))
        with np.errstate(invalid="ignore"):
            for j in range(p):  # an infinity mustn't meet the zero of a row that the pair leaves out
                rows = z[there[:, j]]
                sums[:, :, j] = rows.sum(axis=0), np.square(rows).sum(axis=0), (rows * rows[:, j:j + 1]).sum(axis=0)
        return cls(m.T @ m, *sums, low, high)

    def add(self, other: _Sums) -> None:
        for name in ("n", "s", "q", "xy"):
            getattr(self, name).__iadd__(getattr(other, name))
        np.minimum(self.low, other.low, out=self.low)
        np.maximum(self.high, other.high, out=self.high)


def _packed(held: dict, keys: int, schema: pa.Schema, p: int) -> pa.RecordBatch:
    i, j = np.triu_indices(p)
    columns: list[list] = [[] for _ in range(keys)]
    values: list[list[np.ndarray]] = [[] for _ in range(10)]
    for key, t in held.items():
        for column, k in zip(columns, key):
            column += [k] * len(i)
        told = (t.n[i, j], t.s[i, j], t.s[j, i], t.q[i, j], t.q[j, i], t.xy[i, j], t.low[i, j], t.high[i, j], t.low[j, i], t.high[j, i])
        for column, v in zip(values, told):
            column.append(v)
    n = len(held)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
    arrays += [pa.array(np.tile(i, n).astype(np.int32)), pa.array(np.tile(j, n).astype(np.int32))]
    arrays += [pa.array(np.concatenate(v) if v else [], pa.float64()) for v in values]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _grouped(columns: Sequence[pa.Array]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each group of a batch with the places of its rows; only one value per group is made a Python object."""
    code = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        encoded = c.dictionary_encode(null_encoding="encode")
        code = np.unique(code, return_inverse=True)[1] * len(encoded.dictionary) + encoded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        yield tuple(c[int(at[0])].as_py() for c in columns), at


def _summed(keys: int, schema: pa.Schema, shift: np.ndarray):
    p = len(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Sums] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[keys:]])
            if keys:
                parts = _grouped(batch.columns[:keys])
            else:
                parts = [((), slice(None))]
            for key, at in parts:
                part = _Sums.of(x[at], shift)
                if key in held:
                    held[key].add(part)
                else:
                    held[key] = part
            if 6 * p * p * len(held) > HELD_NUMBERS:
                yield _packed(held, keys, schema, p)
                held = {}
        if held:
            yield _packed(held, keys, schema, p)

    return run


def gram(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """A row ``(within..., _i, _j, n, mean_x, mean_y, cxx, cyy, cxy, varies)`` for every pair of columns ``_i <= _j``.

    Over the rows where both columns are present: their number, means, population variances and covariance, and whether both take
    more than one value. Not-a-number counts as a value and makes all of its pair's results NaN. Groups may be null.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    p = len(columns)
    numbers = [f"_c{i}" for i in range(p)]
    keys = [f"_g{i}" for i in range(len(within))]
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    given = df.select(*[F.col(f"`{g}`").alias(k) for g, k in zip(within, keys)], *[v.alias(n) for v, n in zip(value, numbers)])
    centre = given.agg(*[F.avg(F.when(~F.isnan(n) & (F.abs(n) < float("inf")), F.col(n))).alias(n) for n in numbers]).first()
    shift = [float(c) if c is not None and np.isfinite(c) else 0.0 for c in centre]
    # Within numpy NaN stands for a null; where NaN is a value an infinity makes the sums undefined.
    safe = given.select(*keys, *[F.when(F.isnan(n), F.lit(float("inf"))).otherwise(F.col(n)).alias(n) for n in numbers])
    kinds = ", ".join([*(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keys), "_i int, _j int", *(f"{c} double" for c in (*_SUMS, *_ENDS))])
    empty = df.sparkSession.createDataFrame([], kinds)
    parts = safe.mapInArrow(_summed(len(keys), to_arrow_schema(empty.schema), np.array(shift)), kinds)
    total = parts.groupBy(*keys, "_i", "_j").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("min_x").alias("min_x"), F.max("max_x").alias("max_x"), F.min("min_y").alias("min_y"), F.max("max_y").alias("max_y"))
    at = F.array(*[F.lit(s) for s in shift])

    def mean(s: str) -> Column:
        return F.try_divide(s, "n")

    def second(q: str, a: str, b: str) -> Column:
        return F.try_divide(F.col(q) - F.col(a) * mean(b), "n")

    return total.select(
        *[F.col(k).alias(g) for k, g in zip(keys, within)], "_i", "_j", F.col("n").cast("long").alias("n"),
        (F.get(at, F.col("_i")) + mean("sx")).alias("mean_x"), (F.get(at, F.col("_j")) + mean("sy")).alias("mean_y"),
        F.greatest(second("sxx", "sx", "sx"), F.lit(0.0)).alias("cxx"), F.greatest(second("syy", "sy", "sy"), F.lit(0.0)).alias("cyy"),
        second("sxy", "sx", "sy").alias("cxy"), ((F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y"))).alias("varies"),
    )
