"""Boosted regression trees of many clusters and settings, grown together.

Values are cut into bins once per cluster. Trees grow by levels: in one pass over the rows every task adds up, for each model, the
number and the sum of the targets by node, feature and bin; the sums of a model meet in one reducer, which finds the best split
of each node, and only the splits reach the driver. All clusters and all settings take the same pass, so a grid costs as many passes
as its deepest setting alone. Rows keep their predictions of each model from round to round. Blocks of a cluster lie side by side in a
number of tasks that follows the cores, so the sums a pass sends follow tasks, models and nodes, not rows.

A pass is a job of its own, and a grid takes hundreds of them. Where the rows of a cluster fit a task (``HERE_BYTES``), and there are as many
models as cores or the rows are few (``HERE_ROWS``), the rows go to tasks instead, and each boosts some of the models from their first round
to the last; splits are the same.

A fit of 100 rounds holds all shorter ones: after each round the error over the rows held out is known for every setting, so settings
which differ in their number of rounds only share a fit.

Rounds follow the usual boosting by squared error: the first tree is fitted to the label and counts in full, later ones are fitted to
twice what is left of it and count by the step. A split goes between bins, leaves ``minInstancesPerNode`` rows on both sides and
lowers the squared error; of equal ones the first feature's lowest is taken. Rows with a missing feature, label or cluster are left out.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.encode import assembler, cast_stage
from punctual.operators.regress import (
    BOOSTING, BOOSTING_GRID, SEED, TRAIN_RATIO, TREE, all_features, by_cluster, cluster_labels, cluster_rows, estimator, features_of, held_out, map_clusters,
    regression_scores, scored_report, tuning_report,
)
from punctual.staging import staging_root, stage

BINS = 32
#: Rows of a task at least; small frames get few tasks, since every pass starts them all.
TASK_ROWS = 8192
#: Tasks for each core at most: every task sends the sums of its models, so their number doesn't follow the rows.
TASKS_PER_CORE = 2
#: Rows that walk down a tree together, so that what a step makes stays in the processor's cache.
WALK_ROWS = SUM_ROWS = 16_384
#: Levels whose nodes are walked one by one over all rows; each takes a few operations on bytes.
BYTE_LEVELS = 5
#: What the rows of a cluster may take in a task that boosts whole models, and their number where there are fewer models than cores.
HERE_BYTES, HERE_ROWS = 512 << 20, 4_000_000
#: Tasks for each core where models or trees grow whole.
SHARES_PER_CORE = 4
BLOCK_ROWS = 65_536
#: Rounds after which the rows' predictions are written, so that a lost executor costs no more than these.
WRITTEN_AFTER = 25
QUANTILE_ACCURACY = 10_000
#: Sums of a pass that go straight to the driver, of all tasks together; more than that meet in reducers first.
DIRECT_BYTES = 64 << 20


@dataclass(frozen=True)
class Setting:
    maxDepth: int = 5
    minInstancesPerNode: int = 1
    stepSize: float = 0.1


@dataclass
class Tree:
    """Nodes as a heap: the children of ``i`` are ``2 i + 1`` (bin no greater) and ``2 i + 2``. A leaf's feature is -1."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int16), np.zeros(size, np.uint8), np.zeros(size))

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1

    def reached(self, level: int) -> np.ndarray:
        """What is told of rows at each place of a level; those at a leaf above go on to the left with its value."""
        value = self.value[:1]
        for l in range(level):
            nodes = slice(2 ** l - 1, 2 ** (l + 1) - 1)
            below = self.value[2 ** (l + 1) - 1:2 ** (l + 2) - 1].copy()
            below[::2] = np.where(self.feature[nodes] >= 0, below[::2], value)
            value = below
        return value

    def nodes(self, bins: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node of each row after ``levels`` steps, or its leaf."""
        inner = self.feature >= 0
        out = np.zeros(len(bins), np.int64)
        if not inner.any():
            return out
        levels = (len(self.feature).bit_length() - 1) if levels is None else levels
        feature, place = np.maximum(self.feature, 0).astype(np.int64), np.arange(len(inner))
        # A leaf goes on to itself, since no bin is beyond its cut.
        step, cut = np.where(inner, 2 * place + 1, place), np.where(inner, self.bin, 255).astype(np.uint8)
        flat, p = np.ascontiguousarray(bins).reshape(-1), bins.shape[1]
        for first in range(0, len(bins), WALK_ROWS):
            node = out[first:first + WALK_ROWS]
            start = np.arange(first, first + len(node)) * p
            for _ in range(levels):
                node[:] = step.take(node) + (flat.take(start + feature.take(node)) > cut.take(node))
        return out


class _Walk:
    """The way of rows down a tree, by their places in a level. At a leaf they go on to the left, to places which aren't in the tree."""

    def __init__(self, tree: Tree) -> None:
        inner = tree.feature >= 0
        self.feature, self.cut = np.maximum(tree.feature, 0), np.where(inner, tree.bin, np.uint8(255))

    def step(self, place: np.ndarray, level: int, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        nodes = slice(2 ** level - 1, 2 ** (level + 1) - 1)
        right = flat.take(start + self.feature[nodes].take(place)) > self.cut[nodes].take(place)
        place = place * 2
        place += right
        return place

    def bytes(self, place: np.ndarray, level: int, columns: np.ndarray) -> np.ndarray:
        """The step of places of one byte, node by node."""
        base, right = 2 ** level - 1, np.zeros(len(place), bool)
        for i in range(base + 1):
            if self.cut[base + i] < 255:
                beyond = columns[self.feature[base + i]] > self.cut[base + i]
                beyond &= place == i
                right |= beyond
        place = place + place
        place += right
        return place

    def all(self, columns: np.ndarray, flat: np.ndarray, start: np.ndarray, levels: int, rows: np.ndarray | None = None) -> np.ndarray:
        """The places of all rows of a block, or of some, after ``levels`` steps."""
        place = np.zeros(len(start), np.uint8)
        for level in range(min(levels, BYTE_LEVELS)):
            place = self.bytes(place, level, columns)
        place = (place if rows is None else place.take(rows)).astype(np.int64)
        start = start if rows is None else start.take(rows)
        for level in range(BYTE_LEVELS, levels):
            place = self.step(place, level, flat, start)
        return place


def _add_told(told: np.ndarray, tree: Tree, columns: np.ndarray, flat: np.ndarray, start: np.ndarray, depths: Sequence[int]) -> None:
    """Add what the tree, cut at each depth, tells of the rows of a block."""
    walk, values = _Walk(tree), [tree.reached(d) for d in depths]
    many = max(1, len(flat) // max(len(start), 1))
    for first in range(0, len(start), SUM_ROWS):
        rows = slice(first, first + SUM_ROWS)
        here, begin, at, level = flat[first * many:(first + SUM_ROWS) * many], start[:len(start[rows])], None, 0
        for i in np.argsort(depths):
            if at is None or level < BYTE_LEVELS:
                at = walk.all(columns[:, rows], here, begin, depths[i])
            else:
                for l in range(level, depths[i]):
                    at = walk.step(at, l, here, begin)
            level = depths[i]
            told[i, rows] += values[i].take(at)


@dataclass
class Boosted:
    """A fitted model of one cluster: thresholds by feature, trees, and how much the later ones count."""

    features: list[str]
    thresholds: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)
    step: float = 0.1
    featureImportances: DenseVector | None = None

    @property
    def stages(self) -> list[Boosted]:
        return [self]

    def transform(self, rows: DataFrame) -> DataFrame:
        model = rows.sparkSession.sparkContext.broadcast((self.features, self.thresholds, self.trees, self.step))

        def told(values: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            boosted = Boosted(*model.value)
            for v in values:
                yield pd.Series(boosted.predict(v.to_numpy(dtype=np.float64)))

        given = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"_{i}") for i, f in enumerate(self.features)])
        return rows.withColumn("prediction", F.pandas_udf(told, "double")(given))

    def predict(self, values: np.ndarray, rounds: int | None = None) -> np.ndarray:
        bins = binned(values, self.thresholds)
        columns, flat, start = np.ascontiguousarray(bins.T), bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        out = np.zeros(len(bins))
        for i, tree in enumerate(self.trees[:rounds]):
            added = np.zeros((1, len(bins)))
            _add_told(added, tree, columns, flat, start, [tree.depth])
            out += (self.step if i else 1.0) * added[0]
        return out


def binned(values: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(t, values[:, j]).astype(np.uint8) for j, t in enumerate(thresholds)]) if len(thresholds) else np.zeros((len(values), 0), np.uint8)


def best_splits(counts: np.ndarray, sums: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Feature (or -1), bin, and number and sum to the left and in all, by node. Arrays are node x feature x bin."""
    n, s = counts[:, 0].sum(axis=1), sums[:, 0].sum(axis=1)
    left_n, left_s = counts.cumsum(axis=2), sums.cumsum(axis=2)
    right_n, right_s = n[:, None, None] - left_n, s[:, None, None] - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s ** 2 / left_n + right_s ** 2 / right_n - (s ** 2 / n)[:, None, None]
    gain[(left_n < max(least, 1)) | (right_n < max(least, 1))] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    rows = np.arange(len(gain))
    enough = flat[rows, best] > 1e-12 * np.maximum(1.0, s ** 2 / np.maximum(n, 1))
    feature, cut = np.divmod(best, gain.shape[2])
    return np.where(enough, feature, -1), cut, left_n[rows, feature, cut], left_s[rows, feature, cut], n, s


def _parted(total: np.ndarray, cells: int = BINS) -> np.ndarray:
    """Numbers and sums by node, feature seen and bin."""
    by_node = total.reshape(len(total), -1, cells).transpose(1, 0, 2)
    return np.stack([by_node.real, by_node.imag])


def _dealt(blocks: RDD, places: Sequence[int]) -> RDD:
    """The blocks that each task needs, those of its place."""
    goes = {c: [i for i, place in enumerate(places) if place == c] for c in set(places)}
    return blocks.flatMap(lambda b: [(i, b) for i in goes.get(b[0], [])]).partitionBy(len(places), int).values()


class _Block:
    """Rows of one cluster, held out or not, with their predictions by setting."""

    __slots__ = ("place", "held", "bins", "y", "told")

    def __init__(self, place: int, held: bool, bins: np.ndarray, y: np.ndarray, told: np.ndarray) -> None:
        self.place, self.held, self.bins, self.y, self.told = place, held, bins, y, told


def _packer(columns: int, thresholds: dict[int, list[np.ndarray]]):
    """Rows (place, held, y, features...) as blocks of one cluster each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, list] = {}

        def told(key: tuple) -> pa.RecordBatch:
            bins, y = (np.concatenate(x) for x in zip(*waiting.pop(key)))
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                names=["place", "held", "bins", "y"])

        for batch in batches:
            place, held, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]]) if columns else np.zeros((len(y), 0))
            for key in sorted(set(zip(place.tolist(), held.tolist()))):
                at = (place == key[0]) & (held == key[1])
                parts = waiting.setdefault(key, [])
                parts.append((binned(values[at], thresholds[key[0]]), y[at]))
                if sum(len(p[1]) for p in parts) >= BLOCK_ROWS:
                    yield told(key)
        for key in list(waiting):
            yield told(key)

    return run


@dataclass
class Grown:
    """What a run of all settings gives: trees by cluster and setting, and R² over the held rows after each round."""

    clusters: list
    features: dict[Any, list[str]]
    thresholds: dict[Any, list[np.ndarray]]
    settings: list[Setting]
    trees: dict[tuple[Any, int], list[Tree]]
    scores: dict[tuple[Any, int], list[float | None]]
    lowered: dict[tuple[Any, int], np.ndarray]  # what the splits by each feature lower the squared error by

    def model(self, cluster: Any, setting: int, rounds: int | None = None) -> Boosted:
        return Boosted(self.features[cluster], self.thresholds[cluster], self.trees[cluster, setting][:rounds], self.settings[setting].stepSize)


def _prepared(df: DataFrame, features: Mapping[Any, Sequence[str]], label: str, cluster: str, held) -> DataFrame:
    """``_place``, ``_held``, ``_y``, ``_0`` ... : complete rows; a feature that isn't the cluster's is 0."""
    clusters = list(features)
    every = list(dict.fromkeys(f for fs in features.values() for f in fs))
    place = F.create_map(*itertools.chain.from_iterable((F.lit(c), F.lit(i)) for i, c in enumerate(clusters)))[F.col(cluster)]
    own = [F.col(cluster).isin([c for c in clusters if f in features[c]]) for f in every]
    values = [F.when(o, F.col(f).cast("double")).otherwise(F.lit(0.0)).alias(f"_{i}") for i, (f, o) in enumerate(zip(every, own))]
    return df.select(place.alias("_place"), held.alias("_held"), F.col(label).cast("double").alias("_y"), *values).dropna()


def _thresholds(rows: DataFrame, p: int) -> dict[int, list[np.ndarray]]:
    cuts = [i / BINS for i in range(1, BINS)]
    quantiles = rows.filter(~F.col("_held")).groupBy("_place").agg(
        *[F.percentile_approx(f"_{i}", cuts, QUANTILE_ACCURACY).alias(f"_{i}") for i in range(p)], *[F.max(f"_{i}").alias(f"m{i}") for i in range(p)])
    # A cut at the greatest value would leave nothing on its right.
    return {r["_place"]: [np.unique([v for v in r[f"_{i}"] if v < r[f"m{i}"]]) for i in range(p)] for r in quantiles.collect()}


def library_thresholds(rows: DataFrame, features: Sequence[str], label: str, seed: int, **settings) -> list[np.ndarray]:
    """The thresholds by feature that the library's fit to these rows would find, from the rows that it draws."""
    jvm, model = rows.sparkSession.sparkContext._jvm, estimator("boosting", label, seed=seed, **settings)
    prepared = assembler([f"{f}_double" for f in features]).transform(cast_stage(features).transform(rows))
    model._transfer_params_to_java()
    trees = jvm.org.apache.spark.ml.tree.impl
    instances = getattr(getattr(jvm.org.apache.spark.ml.util, "DatasetUtils$"), "MODULE$").extractInstances(model._java_obj, prepared._jdf, jvm.scala.Option.empty())
    if instances.isEmpty():
        return []
    strategy = model._java_obj.getOldBoostingStrategy(jvm.PythonUtils.toScalaMap({}), jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()).treeStrategy()
    found = getattr(getattr(trees, "RandomForest$"), "MODULE$").findSplits(instances, trees.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all"), seed)
    return [np.array([split.threshold() for split in of], float) for of in found]


def _histograms(trees: dict[tuple[int, int], Tree], level: int, first: bool, settings: list[Setting], p: int, cells: int = BINS):
    """((place, setting), sums by node, feature and bin) of a task, and with ``level`` 0 the held rows' errors under ("e", place)."""

    def run(blocks: Iterator[_Block]) -> Iterator[tuple]:
        total: dict[tuple, np.ndarray] = {}
        walks = {key: _Walk(tree) for key, tree in trees.items()}
        for b in blocks:
            if b.held:
                if level == 0:
                    errors = np.r_[np.square(b.y[:, None] - b.told).sum(axis=0), len(b.y), b.y.sum(), np.square(b.y).sum()]
                    total["e", b.place] = total.get(("e", b.place), 0) + errors
                continue
            columns, flat, start = np.ascontiguousarray(b.bins.T), np.ascontiguousarray(b.bins).reshape(-1), np.arange(SUM_ROWS) * p
            for m, setting in enumerate(settings):
                key = b.place, m
                if level >= setting.maxDepth or key not in trees:
                    continue
                sums = total.setdefault(key, np.zeros((p, 2 ** level * cells), complex))
                for i in range(0, len(b.y), SUM_ROWS):
                    part = slice(i, min(i + SUM_ROWS, len(b.y)))
                    both = np.ones(part.stop - i, complex)
                    both.imag = b.y[part] if first else 2 * (b.y[part] - b.told[part, m])
                    base = walks[key].all(columns[:, part], flat[i * p:part.stop * p], start[:part.stop - i], level) * cells
                    for f in range(p):
                        np.add.at(sums[f], base + columns[f, part], both)
        for key, sums in total.items():
            if key[0] != "e":
                sums = _parted(sums, cells)
                sums[:, ~_grown_nodes(trees[key], level)] = 0
            yield key, sums

    return run


def _grown_nodes(tree: Tree, level: int) -> np.ndarray:
    """Which places of a level are nodes of the tree."""
    return np.repeat(tree.feature[2 ** (level - 1) - 1:2 ** level - 1] >= 0, 2) if level else np.ones(1, bool)


def _decided(settings: list[Setting]):
    def run(item: tuple) -> tuple:
        key, sums = item
        return key, (sums if key[0] == "e" else best_splits(sums[0], sums[1], settings[key[1]].minInstancesPerNode))

    return run


def _told(trees: dict[tuple[int, int], Tree], weights: list[float]):
    """The block with the round's trees in its predictions."""

    def run(b: _Block) -> _Block:
        told = b.told.copy()
        columns, flat, start = np.ascontiguousarray(b.bins.T), np.ascontiguousarray(b.bins).reshape(-1), np.arange(len(b.y)) * b.bins.shape[1]
        for m, weight in enumerate(weights):
            if (b.place, m) in trees:
                tree, added = trees[b.place, m], np.zeros((1, len(b.y)))
                _add_told(added, tree, columns, flat, start, [tree.depth])
                told[:, m] += weight * added[0]
        return _Block(b.place, b.held, b.bins, b.y, told)

    return run


def _place_splits(tree: Tree, level: int, found: tuple[np.ndarray, ...], lowered: np.ndarray) -> bool:
    """Write the splits of a level into the tree and what they lower the squared error by; whether any node goes on."""
    feature, cut, left_n, left_s, n, s = found
    base = 2 ** level - 1
    goes_on = False
    for i in np.flatnonzero(n > 0):
        node = base + i
        tree.value[node] = s[i] / n[i]
        if feature[i] >= 0:
            goes_on = True
            tree.feature[node], tree.bin[node] = feature[i], cut[i]
            tree.value[2 * node + 1], tree.value[2 * node + 2] = left_s[i] / left_n[i], (s[i] - left_s[i]) / (n[i] - left_n[i])
            lowered[feature[i]] += left_s[i] ** 2 / left_n[i] + (s[i] - left_s[i]) ** 2 / (n[i] - left_n[i]) - s[i] ** 2 / n[i]
    return goes_on


def _spread(packed: DataFrame, tasks: int) -> dict[tuple[int, int], int]:
    """The task of each block: blocks of a cluster side by side, with about as many rows in every task."""
    sizes = sorted((r["place"], r["block"], r["size"]) for r in packed.groupBy("place", "block").agg(F.sum(F.length("y")).alias("size")).collect())
    total, upto, goes = sum(size for *_, size in sizes), 0, {}
    for place, block, size in sizes:
        goes[place, block] = min(tasks - 1, int((upto + size / 2) * tasks // total))
        upto += size
    return goes


def grow(
    df: DataFrame, features: Mapping[Any, Sequence[str]], label: str, settings: Sequence[Setting], rounds: int, cluster: str = "cluster", held=None,
    pairs: set[tuple[Any, int]] | None = None, cuts: Callable[[DataFrame, int], dict[int, list[np.ndarray]]] | None = None,
) -> Grown:
    """Boost the settings for every cluster of ``features`` (or the ``pairs`` of cluster and setting); rows where ``held`` is true are only scored."""
    spark, settings, clusters = df.sparkSession, list(settings), list(features)
    every = list(dict.fromkeys(f for fs in features.values() for f in fs))
    p, m = len(every), len(settings)
    rows = stage(_prepared(df, features, label, cluster, F.lit(False) if held is None else held), "boosting-rows")
    thresholds = (cuts or _thresholds)(rows, p)
    sc = spark.sparkContext
    tasks = max(1, min(math.ceil(rows.count() / TASK_ROWS), TASKS_PER_CORE * sc.defaultParallelism))
    packed = stage(
        rows.filter(F.col("_place").isin(list(thresholds))).coalesce(tasks).mapInArrow(_packer(p, thresholds), "place int, held boolean, bins binary, y binary"), "boosting-blocks").withColumn("block", F.xxhash64("held", "bins", "y"))
    goes = _spread(packed, tasks)
    cells = max([BINS, *(len(t) + 1 for ts in thresholds.values() for t in ts)])
    present = sorted(thresholds)
    keys = [(c, i) for c in present for i in range(m) if pairs is None or (clusters[c], i) in pairs]
    sizes = {r["place"]: r["bytes"] // 8 for r in packed.groupBy("place").agg(F.sum(F.length("y")).alias("bytes")).collect()}
    many = len(keys) >= sc.defaultParallelism
    fits = {c for c, n in sizes.items() if n * (2 * p + 34) <= HERE_BYTES and (many or n <= HERE_ROWS) and rounds > 1}
    models = _boosted_here(packed, [key for key in keys if key[0] in fits], settings, rounds, p, cells) if fits else {}
    if beyond := [key for key in keys if key[0] not in fits]:
        models.update(_boosted_by_passes(packed.filter(F.col("place").isin([c for c, _ in beyond])), goes, tasks, beyond, settings, rounds, p, cells))
    return Grown(
        [clusters[c] for c in present], {c: every for c in clusters}, {clusters[c]: t for c, t in thresholds.items()}, settings,
        *({(clusters[c], i): told[k] for (c, i), told in models.items()} for k in range(3)))


def _boosted_here(packed: DataFrame, keys: list[tuple[int, int]], settings: list[Setting], rounds: int, p: int, cells: int) -> dict[tuple[int, int], tuple]:
    """Trees, R² after each round and what the splits by each feature lower the squared error by, from tasks that each have all rows of a cluster."""
    sc = packed.sparkSession.sparkContext
    of: dict[int, list[int]] = {}
    for c, i in keys:
        of.setdefault(c, []).append(i)
    tasks: list[tuple[int, list[int], int]] = []
    for c, numbers in of.items():
        loads = [[0, []] for _ in range(min(len(numbers), math.ceil(SHARES_PER_CORE * sc.defaultParallelism / len(of))))]
        for i in sorted(numbers, key=lambda i: -settings[i].maxDepth):
            least = min(loads, key=lambda load: load[0])
            least[0] += settings[i].maxDepth
            least[1].append(i)
        tasks += [(c, some, load) for load, some in loads]
    tasks.sort(key=lambda task: -task[2])

    def block(r) -> tuple:
        y = np.frombuffer(r.y)
        return r.place, np.frombuffer(r.bins, np.uint8).reshape(len(y), p), y, r.block, r.held

    def run(k: int, blocks: Iterator[tuple]) -> Iterator[tuple]:
        place, some, _ = tasks[k]
        blocks = sorted(blocks, key=lambda b: b[3])
        rows, held = (_Rows(part, p) for part in ([b for b in blocks if not b[4]], [b for b in blocks if b[4]]))
        for i in some:
            yield (place, i), _boosted(rows, held, settings[i], rounds, cells)

    return dict(_dealt(packed.rdd.map(block), [c for c, *_ in tasks]).mapPartitionsWithIndex(run).collect())


class _Rows:
    """Rows of a cluster by row and by column, in parts."""

    def __init__(self, blocks: list[tuple], p: int) -> None:
        self.bins = np.concatenate([np.zeros((0, p), np.uint8), *[b[1] for b in blocks]])
        self.y, self.columns = np.concatenate([np.zeros(0), *[b[2] for b in blocks]]), np.ascontiguousarray(self.bins.T)
        self.parts = [slice(i, min(i + SUM_ROWS, len(self.y))) for i in range(0, len(self.y), SUM_ROWS)]
        self.start = np.arange(SUM_ROWS) * p

    def of(self, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.columns[:, part], self.bins[part].reshape(-1), self.start[:part.stop - part.start]


def _boosted(rows: _Rows, held: _Rows, setting: Setting, rounds: int, cells: int) -> tuple[list[Tree], list[float | None], np.ndarray]:
    p, n, depth = len(rows.columns), len(rows.y), setting.maxDepth
    told, held_told, both = np.zeros(n), np.zeros(len(held.y)), np.ones(n, complex)
    labels = len(held.y), held.y.sum(), np.square(held.y).sum()
    trees, scores, lowered = [], [], np.zeros(p)
    for r in range(rounds):
        both.imag = 2 * (rows.y - told) if r else rows.y
        tree, level, grows = Tree.empty(depth), 0, np.ones(1, bool)
        places = np.zeros(n, np.uint8 if depth <= 8 else np.int64)
        while level < depth and grows.any():
            total = np.zeros((p, 2 ** level * cells), complex)
            for part in rows.parts:
                base = places[part].astype(np.int64)
                base *= cells
                for f in range(p):
                    np.add.at(total[f], base + rows.columns[f, part], both[part])
            sums = _parted(total, cells)
            sums[:, ~grows] = 0
            _place_splits(tree, level, best_splits(*sums, setting.minInstancesPerNode), lowered)
            grows, walk = np.repeat(tree.feature[2 ** level - 1:2 ** (level + 1) - 1] >= 0, 2), _Walk(tree)
            for part in rows.parts if grows.any() else []:
                columns, flat, start = rows.of(part)
                places[part] = walk.bytes(places[part], level, columns) if level < min(BYTE_LEVELS, 7) else walk.step(places[part].astype(np.int64), level, flat, start)
            level += int(grows.any())
        weight, value, walk = setting.stepSize if r else 1.0, tree.reached(level), _Walk(tree)
        for part in rows.parts:
            told[part] += weight * value.take(places[part])
        for part in held.parts:
            held_told[part] += weight * value.take(walk.all(*held.of(part), level))
        trees.append(tree)
        scores.append(_explained(np.square(held.y - held_told).sum(), *labels))
    return trees, scores, lowered


def _boosted_by_passes(
    packed: DataFrame, goes: Mapping[tuple[int, int], int], tasks: int, keys: list[tuple[int, int]], settings: list[Setting], rounds: int, p: int, cells: int,
) -> dict[tuple[int, int], tuple]:
    """As ``_boosted_here``, from a pass over all rows for each level of each round."""
    spark, m, present = packed.sparkSession, len(settings), sorted({c for c, _ in keys})
    sc = spark.sparkContext
    tasks_of = {c: len({t for (place, _), t in goes.items() if place == c}) for c in present}

    def block(r) -> _Block:
        y = np.frombuffer(r.y)
        return _Block(r.place, r.held, np.frombuffer(r.bins, np.uint8).reshape(len(y), p), y, np.zeros((len(y), m)))

    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(staging_root(spark))
    state: RDD = packed.rdd.map(lambda r: (goes[r.place, r.block], r)).partitionBy(tasks, int).values().map(block).persist(StorageLevel.MEMORY_AND_DISK)
    reducers = max(1, min(len(keys), sc.defaultParallelism))
    trees: dict[tuple[int, int], list[Tree]] = {key: [] for key in keys}
    errors: dict[int, list[np.ndarray]] = {c: [] for c in present}
    lowered = {key: np.zeros(p) for key in trees}
    before: RDD | None = None
    for r in range(rounds + 1):
        new = {(c, i): Tree.empty(settings[i].maxDepth) for c, i in trees} if r < rounds else {}
        growing = dict(new)
        for level in range(max(s.maxDepth for s in settings) if new else 1):
            sums = state.mapPartitions(_histograms(growing, level, r == 0, settings, p, cells))
            if sum(tasks_of[c] for c, _ in growing) * 2 ** level * p * cells * 16 <= DIRECT_BYTES:
                total: dict[tuple, np.ndarray] = {}
                for key, value in sums.collect():
                    total[key] = total[key] + value if key in total else value
                found = dict(map(_decided(settings), total.items()))
            else:
                found = dict(sums.reduceByKey(np.add, reducers).map(_decided(settings)).collect())
            if level == 0:
                for c in present:
                    errors[c].append(found.pop(("e", c), np.zeros(m + 3)))
                if before is not None:
                    before.unpersist()
            growing = {key: growing[key] for key, splits in found.items() if _place_splits(growing[key], level, splits, lowered[key])}
            if not growing:
                break
        if not new:
            break
        for key, tree in new.items():
            trees[key].append(tree)
        before, state = state, state.map(_told(new, [s.stepSize if r else 1.0 for s in settings])).persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % WRITTEN_AFTER == 0:
            state.checkpoint()
    state.unpersist()
    return {(c, i): (told, [_explained(e[i], *e[m:]) for e in errors[c][1:]], lowered[c, i]) for (c, i), told in trees.items()}


def _explained(error: float, n: float, total: float, squares: float) -> float | None:
    """R² over n rows; None where the label doesn't vary."""
    spread = squares - total * total / n if n else 0.0
    return float(1 - error / spread) if spread > 1e-12 * squares else None


def predict(models: Mapping[Any, Boosted], df: DataFrame, features: Mapping[Any, Sequence[str]], label: str, cluster: str = "cluster") -> DataFrame:
    """``(cluster, label, prediction)`` of the complete rows of the modelled clusters."""
    clusters = list(models)
    shared = {c: list(features[c]) for c in clusters}
    every = next(iter(models.values())).features
    p = len(every)
    names = {f: i for i, f in enumerate(dict.fromkeys(f for fs in shared.values() for f in fs))}
    rows = _prepared(df, shared, label, cluster, F.lit(False)).select("_place", "_y", *[f"_{names[f]}" if f in names else F.lit(0.0) for f in every])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]) if p else np.zeros((len(place), 0))
            out = np.zeros(len(place))
            for c in np.unique(place):
                at = place == c
                out[at] = models[clusters[c]].predict(values[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["place", "y", "prediction"])

    named = F.get(F.array(*[F.lit(c) for c in clusters]), F.col("place"))
    return rows.mapInArrow(told, "place int, y double, prediction double").select(
        named.cast(df.schema[cluster].dataType).alias(cluster), F.col("y").alias(label), "prediction")


def fit_trees(
    train: DataFrame, features: Sequence[str] | Mapping[Any, Sequence[str]], label: str, cluster: str = "cluster", maxDepth: int = TREE["maxDepth"],
    minInstancesPerNode: int = TREE["minInstancesPerNode"],
) -> dict[Any, Boosted]:
    """One decision tree for each cluster, all of them grown in one pass a level."""
    table = stage(train, "trees")
    wanted = {c: features_of(features, c) for c in cluster_labels(table.filter(F.col(cluster).isNotNull()), cluster)}
    grown = grow(table, wanted, label, [Setting(maxDepth, minInstancesPerNode)], 1, cluster)
    return {c: grown.model(c, 0) for c in grown.clusters}


def fit_boosted(
    train: DataFrame, features: Sequence[str] | Mapping[Any, Sequence[str]], label: str, cluster: str = "cluster", maxIter: int = BOOSTING["maxIter"],
    maxDepth: int = BOOSTING["maxDepth"], stepSize: float = BOOSTING["stepSize"], minInstancesPerNode: int = 1, seed: int = SEED,
) -> dict[Any, Boosted]:
    """Boosted trees of each cluster with the library's thresholds and importances; all clusters grow in the same passes. The seed draws the rows that give the thresholds."""
    table = by_cluster(train, features, label, cluster)
    return boost_clusters(table, {c: features_of(features, c) for c in cluster_labels(table, cluster)}, label, cluster, maxIter, maxDepth, stepSize, minInstancesPerNode, seed)


def boost_clusters(
    table: DataFrame, wanted: Mapping[Any, Sequence[str]], label: str, cluster: str, maxIter: int, maxDepth: int, stepSize: float, minInstancesPerNode: int = 1,
    seed: int = SEED,
) -> dict[Any, Boosted]:
    """As ``fit_boosted``, for these clusters of a table written by cluster."""
    if not wanted:
        return {}
    places, every = list(wanted), list(dict.fromkeys(f for fs in wanted.values() for f in fs))

    def found(c: Any) -> dict[str, np.ndarray]:
        rows = cluster_rows(table, cluster, c, [*wanted[c], label])
        return dict(zip(wanted[c], library_thresholds(rows, wanted[c], label, seed)))

    cuts = {places.index(c): [of.get(f, np.zeros(0)) for f in every] for c, of in map_clusters(places, found).items() if of}
    grown = grow(table, wanted, label, [Setting(maxDepth, minInstancesPerNode, stepSize)], maxIter, cluster, cuts=lambda rows, p: cuts)
    return {c: _of_own(grown, c, wanted[c]) for c in grown.clusters}


def _of_own(grown: Grown, cluster: Any, own: Sequence[str]) -> Boosted:
    """The model on the cluster's own features, in their order."""
    model, places = grown.model(cluster, 0), [grown.features[cluster].index(f) for f in own]
    at = np.full(len(grown.features[cluster]), -1, np.int16)
    at[places] = np.arange(len(own))
    for tree in model.trees:
        tree.feature = np.where(tree.feature >= 0, at[np.maximum(tree.feature, 0)], -1).astype(np.int16)
    by = grown.lowered[cluster, 0][places]
    return Boosted(list(own), [model.thresholds[i] for i in places], model.trees, model.step, Vectors.dense(by / by.sum() if by.sum() > 0 else by))


def score_models(
    models: Mapping[Any, Boosted], frames: Mapping[str, DataFrame], features: Sequence[str] | Mapping[Any, Sequence[str]], label: str, cluster: str = "cluster",
) -> DataFrame:
    """``(cluster, split, rmse, mae, r2)`` of every split."""
    told = None
    for split, df in frames.items():
        part = predict(models, df, {c: features_of(features, c) for c in models}, label, cluster).withColumn("split", F.lit(split))
        told = part if told is None else told.unionByName(part)
    return regression_scores(told, label, [cluster, "split"])


def nodes(models: Mapping[Any, Boosted], df: DataFrame, cluster: str = "cluster", digits: int = 4) -> DataFrame:
    """``(cluster, tree, node, feature, threshold, value)`` of every node; leaves have no feature. Rows up to the threshold go to node ``2 i + 1``."""
    rows = []
    for c, model in models.items():
        for t, tree in enumerate(model.trees):
            reached = {0}
            for i in range(len(tree.feature)):
                if i in reached:
                    f = int(tree.feature[i])
                    rows.append((c, t, i, model.features[f] if f >= 0 else None, float(model.thresholds[f][tree.bin[i]]) if f >= 0 else None, round(float(tree.value[i]), digits)))
                    reached |= {2 * i + 1, 2 * i + 2} if f >= 0 else set()
    kind = df.schema[cluster].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"`{cluster}` {kind}, tree int, node int, feature string, threshold double, value double")


@dataclass
class Tuned:
    """``models`` by cluster; ``report``: a row for each cluster and setting of the grid, with its R² over the held rows and whether it was chosen."""

    models: dict[Any, Boosted]
    report: DataFrame


def tune(
    train: DataFrame, features: Sequence[str] | Mapping[Any, Sequence[str]], label: str, grid: Mapping[str, Sequence] | None = None, cluster: str = "cluster",
) -> Tuned:
    """Grid search per cluster on an 80/20 division by R²; the best setting (the first of equals) is fitted again to all rows."""
    grid = dict(grid or BOOSTING_GRID)
    table = stage(train, "tuning")
    wanted = {c: features_of(features, c) for c in cluster_labels(table.filter(F.col(cluster).isNotNull()), cluster)}
    every = all_features(features)
    names = [n for n in grid if n != "maxIter"]
    settings = [Setting(**dict(zip(names, values))) for values in itertools.product(*(grid[n] for n in names))]
    held = held_out([cluster, *every, label], 1 - TRAIN_RATIO, SEED)
    grown = grow(table, wanted, label, settings, max(grid["maxIter"]), cluster, held)
    rows, best = [], {}
    for c in grown.clusters:
        told = []
        for values in itertools.product(*grid.values()):
            of = dict(zip(grid, values))
            i = settings.index(Setting(**{n: of[n] for n in names}))
            told.append((grown.scores[c, i][of["maxIter"] - 1], i, of))
        k = max(range(len(told)), key=lambda j: (-math.inf if told[j][0] is None else told[j][0], -j))
        best[c] = told[k][1:]
        rows += [(c, *(float(v) for v in of.values()), score, j == k) for j, (score, _, of) in enumerate(told)]
    again = grow(table, wanted, label, settings, max((of["maxIter"] for _, of in best.values()), default=0), cluster, pairs={(c, i) for c, (i, _) in best.items()})
    return Tuned({c: again.model(c, i, of["maxIter"]) for c, (i, of) in best.items()}, tuning_report(train, cluster, grid, rows))


def score(tuned: Tuned, frames: Mapping[str, DataFrame], features: Sequence[str] | Mapping[Any, Sequence[str]], label: str, cluster: str = "cluster") -> DataFrame:
    """The report with RMSE, MAE and R² of the tuned model in every frame, beside the setting that it has."""
    return scored_report(tuned.report, score_models(tuned.models, frames, features, label, cluster), list(frames), cluster)
