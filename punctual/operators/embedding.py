"""Vectors of category tokens from their co-occurrences.

How often two tokens stand within ``window`` places of each other is counted by each task over its token lists and summed. The counts, as positive
pointwise mutual information, form a sparse symmetric matrix M with a row for each pair that occurs. Its leading eigenvectors come from a
randomised projection: M times a few random columns, orthonormalised, and M again, each product a join and an aggregate. The random
numbers are hashes of the tokens, so neither the number of partitions nor their order changes a vector beyond rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators.gram import gram
from punctual.staging import stage

#: Random columns beyond the wanted ones, and products with M before the last.
MORE_COLUMNS, PRODUCTS = 10, 3
#: Vectors up to this size go to every Python worker, as one matrix; beyond it token lists look theirs up.
BROADCAST_BYTES = 128 << 20
ZERO = 1e-12
#: Different pairs that a task holds before it sends their counts, and the rows of a batch of these.
HELD_PAIRS, SENT_PAIRS = 1 << 20, 1 << 16


def _counted(window: int):
    """Token lists -> ``word``, ``context``, ``n``: how often the context stands at most ``window`` places after the word; a word's own number has no context."""

    def sent(held: list[tuple[np.ndarray, np.ndarray]], places: dict[str, int]) -> Iterator[pa.RecordBatch]:
        words, (pairs, n) = pa.array(places, pa.string()), _merged(held)
        for start in range(0, len(pairs), SENT_PAIRS):
            part = pairs[start:start + SENT_PAIRS]
            context = part & 0xFFFFFFFF
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(part >> 32)), words.take(pa.array(context - 1, mask=context == 0)), pa.array(n[start:start + SENT_PAIRS])],
                names=["word", "context", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            code, lengths, words = _codes(batch.column(0))
            code = np.array([places.setdefault(w, len(places)) for w in words] + [-1], np.int64)[code]
            of = np.repeat(np.arange(len(lengths)), lengths)
            pairs = [code[code >= 0] << 32]
            for apart in range(1, min(window, int(lengths.max(initial=0)) - 1) + 1):
                word, context = code[:-apart], code[apart:]
                there = (of[apart:] == of[:-apart]) & (word >= 0) & (context >= 0)
                pairs.append(word[there] << 32 | context[there] + 1)
            held.append(np.unique(np.concatenate(pairs), return_counts=True))
            if sum(len(p) for p, _ in held) > HELD_PAIRS:
                held = [_merged(held)]
                if 2 * len(held[0][0]) > HELD_PAIRS:
                    yield from sent(held, places)
                    held, places = [], {}
        if held:
            yield from sent(held, places)

    return run


def _codes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The place of each token among the words, -1 for null; the length of each list, 0 for null; the words."""
    flat = lists.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pc.fill_null(flat.indices, -1).to_numpy(zero_copy_only=False), lengths, flat.dictionary.to_pylist()


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    n = np.zeros(len(pairs), np.int64)
    np.add.at(n, at, np.concatenate([n for _, n in held]))
    return pairs, n


def cooccurrences(df: DataFrame, tokens: str = "tokens", window: int = 7, min_count: int = 5) -> DataFrame:
    """``word``, ``context``, ``n``: how often the two stand at most ``window`` places apart, both ways round. Rare tokens keep their place but have no row.

    The lists are read once. A task counts the pairs of its lists and sends the sums, so neither lists nor single pairs are shuffled.
    """
    found = df.select(F.col(tokens).cast("array<string>").alias("t")).mapInArrow(_counted(window), "word string, context string, n long")
    counted = stage(found.groupBy("word", "context").agg(F.sum("n").alias("n")), "token-pairs")
    first = counted.filter(F.col("context").isNotNull())
    both = first.unionByName(first.select(F.col("context").alias("word"), F.col("word").alias("context"), "n"))
    known = counted.filter(F.col("context").isNull() & (F.col("n") >= min_count)).select("word")
    return (
        both.groupBy("word", "context").agg(F.sum("n").alias("n")).join(known, "word", "left_semi")
        .join(known.withColumnRenamed("word", "context"), "context", "left_semi").select("word", "context", "n")
    )


def mutual_information(counts: DataFrame) -> DataFrame:
    """``word``, ``context``, ``v`` of the pairs that occur more often than by chance."""
    totals = counts.groupBy("word").agg(F.sum("n").alias("of_word"))
    every = totals.agg(F.sum("of_word")).first()[0] or 0
    joined = counts.join(totals, "word").join(totals.select(F.col("word").alias("context"), F.col("of_word").alias("of_context")), "context")
    v = F.log(F.col("n") * F.lit(float(every)) / (F.col("of_word").cast("double") * F.col("of_context")))
    return joined.select("word", "context", v.alias("v")).filter(F.col("v") > 0)


def _normal(word: str, i: int, seed: int) -> Column:
    """A normal number from hashes of the word."""
    u, v = (F.shiftrightunsigned(F.xxhash64(word, F.lit(seed), F.lit(2 * i + k)), 11) / F.lit(float(1 << 53)) for k in (0, 1))
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def _columns(n: int) -> list[str]:
    return [f"y{i}" for i in range(n)]


def _times(entries: DataFrame, y: DataFrame, n: int) -> DataFrame:
    """M y."""
    return entries.join(y.withColumnRenamed("word", "context"), "context").groupBy("word").agg(*[F.sum(F.col("v") * F.col(c)).alias(c) for c in _columns(n)])


def _turned(y: DataFrame, matrix: np.ndarray) -> DataFrame:
    """y times a small matrix."""
    out = matrix.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]) @ matrix
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in x.T)], names=["word", *_columns(out)])

    return y.mapInArrow(run, ", ".join(["word string", *(f"{c} double" for c in _columns(out))]))


def _products(df: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """Sums of products of the left columns with the right ones."""
    columns = list(dict.fromkeys([*left, *right]))
    out = np.zeros((len(columns), len(columns)))
    for r in gram(df, columns).collect():
        out[r["_i"], r["_j"]] = out[r["_j"], r["_i"]] = r["n"] * (r["cxy"] + r["mean_x"] * r["mean_y"])
    return out[np.ix_([columns.index(c) for c in left], [columns.index(c) for c in right])]


def _orthonormal(y: DataFrame, n: int, label: str) -> tuple[DataFrame, int]:
    """Orthonormal columns that span those of y; twice, since the first time loses digits where columns are nearly alike."""
    y = stage(y, f"{label}-raw")
    for _ in range(2):
        values, vectors = np.linalg.eigh(_products(y, _columns(n), _columns(n)))
        kept = values > ZERO * max(values.max(), 0.0)
        if not kept.any():
            return y.select("word").limit(0), 0
        y = _turned(y, vectors[:, kept] / np.sqrt(values[kept]))
        n = int(kept.sum())
    return stage(y, label), n


def word_vectors(counts: DataFrame, dims: int = 20, seed: int = 42) -> DataFrame:
    """``word``, ``vector`` (``dims`` doubles): the leading directions of the information, each by the root of its weight; missing ones are 0."""
    entries = stage(mutual_information(counts), "embedding-entries")
    n = dims + MORE_COLUMNS
    y = counts.select("word").distinct().select("word", *[_normal("word", i, seed).alias(c) for i, c in enumerate(_columns(n))])
    for i in range(PRODUCTS):
        y, n = _orthonormal(_times(entries, y, n), n, f"embedding-{i}")
        if not n:
            return counts.select("word").distinct().select("word", F.array_repeat(F.lit(0.0), dims).alias("vector"))
    image = _times(entries, y, n)
    paired = y.join(image.withColumnsRenamed({c: f"z{c}" for c in _columns(n)}), "word").withColumn("side", _normal("word", dims + MORE_COLUMNS, seed))
    small = _products(paired, _columns(n), [*(f"z{c}" for c in _columns(n)), "side"])
    small, side = small[:, :-1], small[:, -1]
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = [i for i in np.argsort(-values) if values[i] > ZERO * values.max()][:dims]
    # Of both directions the one on the side of one more random column.
    turn = vectors[:, best] * np.where(side @ vectors[:, best] < 0, -1, 1) * np.sqrt(values[best])
    found = _turned(y, turn).select("word", F.concat(F.array(*_columns(len(best))), F.array_repeat(F.lit(0.0), dims - len(best))).alias("vector"))
    silent = counts.select("word").distinct().join(found, "word", "left")
    return silent.select("word", F.coalesce("vector", F.array_repeat(F.lit(0.0), dims)).alias("vector"))


@dataclass
class WordVectors:
    """``vectors`` (written): ``word``, ``vector``. A token list's vector is the mean over its tokens; one without a vector counts as zero."""

    vectors: DataFrame
    dims: int
    tokens: str
    out: str
    broadcast_bytes: int = BROADCAST_BYTES

    def getVectors(self) -> DataFrame:
        return self.vectors.select("word", array_to_vector("vector").alias("vector"))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.vectors.count() * (8 * self.dims + 40) <= self.broadcast_bytes:
            return df.withColumn(self.out, array_to_vector(self._told()(F.col(self.tokens))))
        lists = df.select(F.col(self.tokens).alias("_t")).distinct()
        cells = lists.select("_t", F.explode("_t").alias("word")).join(self.vectors, "word")
        sums = cells.groupBy("_t").agg(*[F.sum(F.col("vector")[i]).alias(f"_s{i}") for i in range(self.dims)])
        mean = F.array(*[F.coalesce(F.col(f"_s{i}") / F.size(self.tokens), F.lit(0.0)) for i in range(self.dims)])
        joined = df.join(sums, df[self.tokens].eqNullSafe(sums["_t"]), "left")
        return joined.select(*[df[c] for c in df.columns], array_to_vector(mean).alias(self.out))

    @cached_property
    def _known(self) -> Broadcast:
        """The place of each word and the vectors by place, with zeros at the end."""
        found = self.vectors.select("word", "vector").toArrow()
        values = [c.flatten().to_numpy(zero_copy_only=False) for c in found.column("vector").chunks]
        vectors = np.concatenate([*values, np.zeros(self.dims)]).reshape(-1, self.dims)
        places = {w: i for i, w in enumerate(found.column("word").to_pylist())}
        return self.vectors.sparkSession.sparkContext.broadcast((places, vectors))

    def _told(self):
        dims, known = self.dims, self._known

        @F.arrow_udf("array<double>")
        def told(lists: pa.Array) -> pa.Array:
            places, vectors = known.value
            code, lengths, words = _codes(lists)
            code = np.array([places.get(w, -1) for w in words] + [-1], np.int64)[code]
            start = np.cumsum(lengths) - lengths
            sums = np.zeros((len(lists), dims))
            for i in range(int(lengths.max(initial=0))):
                there = np.flatnonzero(lengths > i)
                sums[there] += vectors[code[start[there] + i]]
            mean = sums / np.maximum(lengths, 1)[:, None]
            return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dims), pa.array(mean.ravel()))

        return told


def fit(df: DataFrame, tokens: str = "tokens", out: str = "category_vec", vectorSize: int = 20, windowSize: int = 7, minCount: int = 5, seed: int = 42) -> WordVectors:
    counts = stage(cooccurrences(df, tokens, windowSize, minCount), "cooccurrences")
    return WordVectors(stage(word_vectors(counts, vectorSize, seed), "word-vectors"), vectorSize, tokens, out)
