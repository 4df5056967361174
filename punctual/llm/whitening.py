"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred vectors of the fit list, one row each, a step takes u = Xv less the part along the u before, and the next v
from X'u less the part along the v before. Both products run in one pass: a task forms its rows of u and their sums X'u and u'u.
Every u is X times a short vector p, which the driver keeps in place of u; so u'u of two steps is p'(X'Xp), and full
reorthogonalisation on both sides needs nothing of the length of the table. After as many steps as dimensions (or once what is
left is zero) X is U B V' with B upper bidiagonal, and the small decomposition of B gives the components V W and the
deviations along them. ``steps`` ends earlier, for wide vectors whose first components are wanted only.

Vectors are counted in whole numbers, x = floor(64 c) + 1000000, and centred before any multiplication: with S = n q + r the
entries x - q are small whole numbers, and r / n is the rest of the mean.

Rows: a null vector, a null or non-finite entry, and a vector whose length isn't the commonest one (of equally common ones the
longest) are dropped; entries beyond 2 ** 40 / 64 count as that. Equal vectors count once in the fit and keep their rows in the
result. Components with a deviation of zero are left out, so fewer than two distinct vectors give no rows. A deviation beyond a
long is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.staging import scratch_tables, stage

# Fixed values of the contract.
SCALE, SHIFT, COMPONENTS = 64.0, 1_000_000, 16

LARGEST = float(1 << 40)
BLOCK_ROWS = 4096
#: What is left counts as zero below this share of the largest deviation.
ZERO = 1e-13
SEED = 20


def counted(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` of the rows that remain."""
    scaled = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", scaled.alias("v")).filter("v is not null").filter(finite)
    common = rows.groupBy(F.size("v").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    size = common.d if common else 0
    entry = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT
    return rows.filter(F.size("v") == size).select("vec_id", F.transform("v", entry).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of x as blocks of little-endian longs."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.column(0).slice(start, BLOCK_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([_matrix(part).astype("<i8").tobytes()], pa.binary())], names=["rows", "x"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield np.frombuffer(block.as_buffer(), "<i8").reshape(rows, -1)


def _summed(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all blocks of the short vector ``of`` makes of each; a task sends its sum, of as many numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"])

    value = F.sum(F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value"))
    found = blocks.mapInArrow(sums, f"at int, value {kind}").groupBy("at").agg(value.alias("value")).collect()
    out = sorted((r["at"], r["value"]) for r in found)
    return np.array([v for _, v in out], dtype=object if kind == "long" else np.float64)


@dataclass
class Centre:
    """The mean of the fit list in whole numbers: S = n q + r, by dimension."""

    n: int
    q: np.ndarray
    r: np.ndarray

    @classmethod
    def of(cls, n: int, sums: np.ndarray) -> Centre:
        q = [int(s) // n for s in sums]
        return cls(n, np.array(q, np.int64), np.array([int(s) - n * a for s, a in zip(sums, q)], np.int64))

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.q).astype(np.float64) - self.r / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S) ** 2; n x - S is n a - r with a = x - q."""
        a = x - self.q
        squares = sum(int(v) ** 2 for v in self.r)
        exact = a.shape[1] * max(float(np.abs(a).max(initial=0)), 1.0) * max(float(np.abs(a).max(initial=0)), float(self.n)) < 2.0 ** 62
        a = a if exact else a.astype(object)
        lengths, along = (a * a).sum(axis=1).tolist(), (a * (self.r if exact else self.r.astype(object))).sum(axis=1).tolist()
        found = [self.n * self.n * int(s) - 2 * self.n * int(t) + squares for s, t in zip(lengths, along)]
        return [v if v < 1 << 63 else None for v in found]


@dataclass
class Whitening:
    centre: Centre
    components: np.ndarray  # a column each
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """V and the upper bidiagonal B of X V = U B. ``product`` gives X'Xp and p'X'Xp of centred rows X; it is called once a step.

    Where the vectors so far span all that X does to them, a new random direction goes on from there, so repeated deviations
    are found as often as they stand.
    """
    random = np.random.default_rng(SEED)

    def across(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
        for _ in range(2 if basis else 0):
            done = np.array(basis)
            v = v - done.T @ (done @ v)
        return v

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        v = across(random.standard_normal(d), basis)
        return v / np.linalg.norm(v)

    vs, ps, zs, alphas, betas = [fresh([])], [], [], [], []
    largest = 0.0
    restarted = True
    while True:
        beta = betas[-1] if betas else 0.0
        p = vs[-1] - (beta * ps[-1] if ps else 0.0)
        z, squared = product(p)
        for p_before, z_before in zip(ps, zs):
            along = float(p_before @ z)
            p, z, squared = p - along * p_before, z - along * z_before, squared - along * along
        alpha = float(np.sqrt(max(squared, 0.0)))
        largest = max(largest, alpha, beta)
        if alpha <= ZERO * largest:
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, z = p / alpha, z / alpha
        ps, zs, alphas = [*ps, p], [*zs, z], [*alphas, alpha]
        if len(vs) == min(d, steps or d) or (restarted and alpha == 0.0):
            break
        onward = across(z - alpha * vs[-1], vs)
        beta = float(np.linalg.norm(onward))
        restarted = beta <= ZERO * largest
        betas.append(0.0 if restarted else beta)
        vs.append(fresh(vs) if restarted else onward / beta)
    return np.array(vs).T, np.diag(alphas) + np.diag(betas, 1)


def fit(x: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """The whitening of the distinct vectors ``x``; None if there is no direction with a deviation."""
    with scratch_tables(x.sparkSession):
        blocks = stage(x.select("x").distinct().mapInArrow(_packed, "rows int, x binary"), "whitening-blocks")
        totals = _summed(blocks, lambda x: np.r_[len(x), x.sum(axis=0)], "long")
        if not len(totals):
            return None
        centre = Centre.of(int(totals[0]), totals[1:])
        d = len(centre.q)
        spread = float(_summed(blocks, lambda x: np.array([np.square(centre.rows(x)).sum()]))[0])

        def product(p: np.ndarray) -> tuple[np.ndarray, float]:
            def both(x: np.ndarray) -> np.ndarray:
                rows = centre.rows(x)
                u = rows @ p
                return np.r_[rows.T @ u, u @ u]

            sums = _summed(blocks, both)
            return sums[:-1], float(sums[-1])

        if spread == 0.0:
            return None
        basis, small = bidiagonalise(product, d, steps)
        _, deviations, turned = np.linalg.svd(small)
        wanted = deviations[:components] > np.sqrt(d) * ZERO * deviations[0]
        found = (basis @ turned.T)[:, :len(deviations)][:, :components][:, wanted]
        found = found / np.linalg.norm(found, axis=0)
        found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
        values = np.square(deviations[:components][wanted]) / centre.n
        weights = found / np.sqrt(values)
        k = len(values)

        def scatter(x: np.ndarray) -> np.ndarray:
            white = centre.rows(x) @ weights
            return (white.T @ white).ravel()

        error = np.abs(_summed(blocks, scatter).reshape(k, k) / centre.n - np.eye(k)).max()
        return Whitening(centre, found, values, values / (spread / centre.n), float(error))


def whiten(vectors: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``: a row for each vector and component."""
    rows = counted(vectors)
    model = fit(rows, components, steps)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            count = len(x)
            place = np.repeat(np.arange(count), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.centre.n, np.int64)), pa.array(model.centre.deviations(x), pa.int64()).take(pa.array(place)),
                    pa.array((model.centre.rows(x) @ model.weights).ravel()), pa.array(np.tile(model.explained, count)),
                    pa.array(np.full(count * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(projected, schema)
