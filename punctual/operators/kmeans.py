"""K-means for several k at once.

The centres of every k move in the same pass: a task adds up, for each centre, the rows nearest to it, and sends as many numbers as
the centres have; the rows themselves are packed once and stay where they are. Distances to all centres of a block are one matrix
product. (Bounds by the triangle inequality would need a state for every row and spare less than that product costs.)

Starts are chosen by distance (the next start in proportion to its squared distance from the nearest one so far) among the
``SAMPLE`` distinct vectors with the smallest hashes; the hash and the choice follow the seed alone, not the layout. Rows without a
vector, or with a value that is no number, are left out and get no label. Of equally near centres the first counts. A centre that no
row is nearest to stays where it was.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.staging import stage

SAMPLE = 2000
ROUNDS = 20
#: A k has settled when none of its centres moves further.
TOLERANCE = 1e-4
BLOCK_ROWS = 8192


def _array(df: DataFrame, features: str) -> Column:
    kind = df.schema[features].dataType.typeName()
    return F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            x = _matrix(batch.column(0).slice(start, BLOCK_ROWS))
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.astype("<f8").tobytes()], pa.binary())], names=["rows", "x"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield np.frombuffer(block.as_buffer(), "<f8").reshape(rows, -1)


def _summed(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches):
            total = of(x) if total is None else total + of(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"])

    found = blocks.mapInArrow(sums, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([v for _, v in sorted((r["at"], r["value"]) for r in found)])


def _sampled(seed: int):
    """The distinct vectors of a task with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, bytes] = {}
        for x in _blocks(batches):
            rows = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel()) if x.shape[1] else []
            for row in rows:
                row = row.tobytes()
                best[hashlib.blake2b(row, digest_size=8, salt=seed.to_bytes(8, "little")).digest()] = row
            if len(best) > 8 * SAMPLE:
                best = dict(sorted(best.items())[:SAMPLE])
        best = dict(sorted(best.items())[:SAMPLE])
        yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.binary()), pa.array(best.values(), pa.binary())], names=["hash", "x"])

    return run


def _starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    random = np.random.default_rng([seed, k])
    chosen = [int(random.integers(len(sample)))]
    far = np.square(sample - sample[chosen[0]]).sum(axis=1)
    while len(chosen) < min(k, len(sample)):
        share = far.cumsum()
        chosen.append(int(np.searchsorted(share, random.random() * share[-1], side="right").clip(0, len(sample) - 1)))
        far = np.minimum(far, np.square(sample - sample[chosen[-1]]).sum(axis=1))
    return sample[chosen]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each row's centre and its squared distance."""
    far = np.square(centres).sum(axis=1) - 2 * (x @ centres.T)
    place = far.argmin(axis=1)
    return place, np.square(x - centres[place]).sum(axis=1)


def _moves(all_centres: list[np.ndarray]):
    """By centre: rows, cost, sum of squared lengths, sum of vectors."""

    def of(x: np.ndarray) -> np.ndarray:
        parts = []
        lengths = np.square(x).sum(axis=1)
        for centres in all_centres:
            place, cost = nearest(x, centres)
            k = len(centres)
            own = np.zeros((len(x), k))
            own[np.arange(len(x)), place] = 1.0
            parts.append(np.column_stack([own.sum(axis=0), np.bincount(place, cost, k), np.bincount(place, lengths, k), own.T @ x]).ravel())
        return np.concatenate(parts)

    return of


def _unpacked(total: np.ndarray, all_centres: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for centres in all_centres:
        size = len(centres) * (centres.shape[1] + 3)
        out.append(total[at:at + size].reshape(len(centres), -1))
        at += size
    return out


@dataclass
class KMeansFit:
    centres: np.ndarray
    features: str
    label: str
    cost: float = math.nan
    silhouette: float | None = None

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def getPredictionCol(self) -> str:
        return self.label

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the label of the nearest centre; null where there is no vector or a value is no number."""
        centres = self.centres

        @F.arrow_udf("int")
        def told(vectors: pa.Array) -> pa.Array:
            there = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
            out = np.full(len(vectors), -1, np.int32)
            if len(there):
                x = _matrix(vectors.take(pa.array(there)))
                fine = np.isfinite(x).all(axis=1)
                out[there[fine]] = nearest(x[fine], centres)[0]
            return pa.array(out, mask=out < 0)

        return df.withColumn(self.label, told(_array(df, self.features)))


def fit(
    df: DataFrame, ks: Sequence[int], features: str = "features", label: str = "cluster", seed: int = 42,
    rounds: int = ROUNDS, tolerance: float = TOLERANCE, silhouettes: bool = False,
) -> dict[int, KMeansFit]:
    """A fit of each k; every round reads the vectors once for all that haven't settled. Fewer distinct vectors than k give as many centres."""
    vectors = df.select(_array(df, features).alias("x")).filter(F.col("x").isNotNull()).filter(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    blocks = stage(vectors.mapInArrow(_packed, "rows int, x binary"), "kmeans-blocks")
    first = blocks.mapInArrow(_sampled(seed), "hash binary, x binary").distinct().orderBy("hash", "x").limit(SAMPLE).collect()
    if not first:
        return {}
    sample = np.array([np.frombuffer(r["x"], "<f8") for r in first])
    centres = {k: _starts(sample, k, seed) for k in dict.fromkeys(ks)}
    moving = list(centres)
    for _ in range(rounds):
        if not moving:
            break
        for k, sums in zip(list(moving), _unpacked(_summed(blocks, _moves([centres[k] for k in moving])), [centres[k] for k in moving])):
            rows = sums[:, :1]
            new = np.where(rows > 0, sums[:, 3:] / np.maximum(rows, 1), centres[k])
            if np.square(new - centres[k]).sum(axis=1).max() <= tolerance ** 2:
                moving.remove(k)
            centres[k] = new
    every = list(centres.values())
    told = _unpacked(_summed(blocks, _moves(every)), every)
    scores = _silhouettes(blocks, every, told) if silhouettes else [None] * len(every)
    return {k: KMeansFit(c, features, label, float(t[:, 1].sum()), s) for (k, c), t, s in zip(centres.items(), told, scores)}


def _silhouettes(blocks: DataFrame, all_centres: list[np.ndarray], told: list[np.ndarray]) -> list[float | None]:
    """Mean silhouette by squared distances of each k, all from one pass; None where fewer than two centres have rows."""

    def of(x: np.ndarray) -> np.ndarray:
        lengths = np.square(x).sum(axis=1)[:, None]
        out = []
        for centres, sums in zip(all_centres, told):
            rows = sums[:, 0]
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = np.where(rows > 0, lengths + sums[:, 2] / rows - 2 * (x @ (sums[:, 3:] / rows[:, None]).T), np.inf)
                place, _ = nearest(x, centres)
                at = np.arange(len(x)), place
                inside = mean[at] * rows[place] / (rows[place] - 1)
                mean[at] = np.inf
                outside = mean.min(axis=1) if mean.shape[1] else np.full(len(x), np.inf)
                score = (outside - inside) / np.maximum(outside, inside)
            out.append(np.where((rows[place] > 1) & np.isfinite(outside), np.nan_to_num(score), 0.0).sum())
        return np.array(out)

    total = _summed(blocks, of)
    return [float(t / s[:, 0].sum()) if (s[:, 0] > 0).sum() > 1 else None for t, s in zip(total, told)]


def settled(labelled: DataFrame, fit: KMeansFit, slack: float = 1e-9) -> DataFrame:
    """One row: how many rows have a label, how many of these are nearer to another label's mean, and whether the centres are the means.

    Means and distances are made row by row from the labels alone; ``features`` is an array here.
    """
    rows = labelled.filter(F.col(fit.label).isNotNull())
    cells = rows.select(fit.label, F.posexplode(fit.features).alias("d", "v")).groupBy(fit.label, "d").agg(F.avg("v").alias("mean"))
    by_label: dict[int, list[float]] = {}
    for r in sorted(cells.collect()):  # as many numbers as the centres have
        by_label.setdefault(r[fit.label], []).append(r["mean"])
    same = bool(np.all([np.square(np.array(m) - fit.centres[c]).sum() <= slack for c, m in by_label.items()]))
    x = F.col(fit.features)

    def distance(mean: Column) -> Column:
        return F.aggregate(F.zip_with(x, mean, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)

    means = F.array(*[F.array(*[F.lit(v) for v in m]) for m in by_label.values()])
    own = F.create_map(*[v for c, m in by_label.items() for v in (F.lit(c), F.array(*[F.lit(v) for v in m]))])[F.col(fit.label)]
    closest = F.array_min(F.transform(means, distance))
    return rows.agg(
        F.count(F.lit(1)).alias("labelled"), F.count_if(distance(own) > closest * (1 + slack) + slack).alias("nearer_elsewhere"),
    ).withColumn("centres_are_means", F.lit(same))
