"""Interpolated modified Kneser-Ney model of words: counted in Spark, stored as sorted arrays, mapped by the workers.

1. Words are counted by 63-bit hashes and written as one sorted array; a word's number is its place there.
2. Pairs become one integer (number of the first word, number of the second), counted per task and dealt out in key order as packed blocks.
   The cut between shards follows the words' counts, also inside one frequent first word, so shards have equal work and none
   depends on a hot word. A task merges the blocks of a shard into one file, and passes on sums per first word and per
   second word, from which discounts, back-off weights and continuation counts come.
3. Triples become one integer too (place of the pair ahead, number of the word), merged likewise. A shard's file holds four bytes per
   triple, the number of its last word, and where the triples of each pair start. Its task also counts the distinct words before
   each pair, which the level of pairs is made of.
4. Counts take one byte; those of 255 and more stand in a list beside them, so no count is too large.
5. Workers map the files and look up whole chunks of texts at a time; nothing of the model is held in memory or broadcast, and
   maps are closed after each lookup, so pages don't add up.

The files lie in the folder of ``spark.checkpoint.dir``, which workers must be able to open as a local or mounted path. Every
file or part is written by one task and is the same whenever it is written again, so lost executors do no harm. Tables between the
steps are deleted once they have been read; ``delete`` removes the model.

``ORDER`` is 3: triples of the words themselves, with continuation counts below and a uniform base. Pairs that start a text have
nothing before them and keep their own counts. Order 2 can be chosen.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import chunks
from punctual.staging import delete_tables, scratch_tables, stage, stage_path

CHUNK_BYTES = 8 << 20
#: Distinct pairs are counted over about so many tokens at a time.
COUNT_TOKENS = 4_000_000
SHARD_TOKENS = 2_000_000
WORD_SHARD_BITS = 6
PAIR_BITS = 31
PLACE_BLOCK_BITS = 20
#: One byte holds counts below this one.
LARGE = 255
#: The followers of a pair are summed as they are asked for up to so many; beyond that their sums are kept.
MANY = 16
#: Tokens before a pair are kept for every 2 ** so many pairs.
MASS_BITS = 5
ORDER = 3
END = b"\n"  # no word holds white space


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder which the driver and all workers can open."""
    place = urlparse(stage_path(spark, label))
    if place.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped from files: {place.scheme}:// needs a mounted path in spark.checkpoint.dir")
    os.makedirs(place.path)
    return place.path


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of all texts as 63-bit hashes, the places there of all tokens, each text closed by the end, and where each text starts."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, lengths = words.flatten(), words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an edge leaves an empty word
    if not full.all():
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[full], minlength=len(lengths))
        flat = flat.filter(pa.array(full))
    encoded = flat.dictionary_encode()
    # Joined by what no word holds, words become Python's in one call.
    n = len(encoded.dictionary)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, n], pa.int64()), encoded.dictionary.cast(pa.large_binary())), pa.scalar(END, pa.large_binary()))
    distinct = [*(joined[0].as_buffer().to_pybytes().split(END) if n else ()), END]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct)) >> np.uint64(1)
    starts = np.cumsum(lengths + 1) - lengths - 1
    place = np.full(len(flat) + len(lengths), len(distinct) - 1, np.int64)
    inner = np.ones(len(place), bool)
    inner[starts + lengths] = False
    place[inner] = encoded.indices.to_numpy(zero_copy_only=False)
    return h.astype(np.int64), place, starts


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts of counts 1 to 4; one half where these don't give any."""
    n = [counts.get(k, 0) for k in (1, 2, 3, 4)]
    if not all(n[:3]):
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    found = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


@dataclass
class Model:
    """What a worker needs to open the model."""

    folder: str
    words: int
    tokens: int
    pairs: int = 0
    d_pair: tuple = (0.5, 0.5, 0.5)
    d_word: tuple = (0.5, 0.5, 0.5)
    word_back: float = 1.0
    first_keys: list[int] = field(default_factory=list)
    shards: list[int] = field(default_factory=list)
    #: Pairs and tokens before each shard of pairs.
    places: list[int] = field(default_factory=list)
    mass: list[int] = field(default_factory=list)
    order: int = 2
    d_triple: tuple = (0.5, 0.5, 0.5)
    first_triples: list[int] = field(default_factory=list)
    triple_shards: list[int] = field(default_factory=list)
    #: Place of the last pair that has triples in each shard.
    last_places: list[int] = field(default_factory=list)

    @property
    def word_bits(self) -> int:
        return self.words.bit_length()


def _file(path: str, rows: int = 1) -> np.ndarray:
    """A file of long numbers in so many rows, mapped."""
    return np.memmap(path, np.int64, "r").reshape(rows, -1) if os.path.getsize(path) else np.empty((rows, 0), np.int64)


class Counts:
    """Counts of a file: a byte each, and places and values of those that don't fit."""

    def __init__(self, path: str):
        self.small, self.large = np.memmap(f"{path}.counts", np.uint8, "r"), _file(f"{path}.large", 2)

    def take(self, at: np.ndarray) -> np.ndarray:
        n = self.small[at].astype(np.int64)
        large = n == LARGE
        if large.any():
            n[large] = self.large[1][np.searchsorted(self.large[0], at[large])]
        return n

    @staticmethod
    def write(path: str, n: np.ndarray) -> None:
        large = np.flatnonzero(n >= LARGE)
        _replace(f"{path}.large", np.stack([large, n[large]]).astype(np.int64))
        _replace(f"{path}.counts", np.minimum(n, LARGE).astype(np.uint8))


def _inside(values: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """First place in ``[low, high)`` whose value isn't below what is asked, by halving; values rise inside each range."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        a, b = low[open_], high[open_]
        middle = (a + b) >> 1
        below = values[middle] < asked[open_]
        a, b = np.where(below, middle + 1, a), np.where(below, b, middle)
        low[open_], high[open_] = a, b
        open_ = open_[a < b]
    return low


def _before_counts(folder: str, places: np.ndarray) -> np.ndarray:
    """Distinct words before the pairs at these places (rising); a block without a file has none."""
    out, block = np.zeros(len(places), np.int64), places >> PLACE_BLOCK_BITS
    for b in np.unique(block):
        x, y = np.searchsorted(block, [b, b + 1])
        if os.path.exists(f"{folder}/before-{b}.counts"):
            out[x:y] = Counts(f"{folder}/before-{b}").take(places[x:y] - (b << PLACE_BLOCK_BITS))
    return out


class Mapped:
    """The arrays of a model, mapped."""

    def __init__(self, model: Model):
        self.model = model
        self.keys, self.counts, self.before = (self._open(n, np.int64, model.words) for n in ("words", "counts", "before"))
        self.continuations, self.context = self._open("continuations", np.int64, model.words), self._open("context", np.int64, model.words + 1)
        self.back = self._open("back", np.float64, model.words + 1)

    def _open(self, name: str, kind, n: int) -> np.ndarray:
        path = f"{self.model.folder}/{name}"
        return np.memmap(path, kind, "r", shape=(n,)) if n and os.path.exists(path) else np.empty(0, kind)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Places of word hashes, -1 for words not met in training."""
        if not len(self.keys):
            return np.full(len(h), -1, np.int64)
        distinct, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return np.where(self.keys[at] == distinct, at, -1)[back]

    def _asked(self, distinct: np.ndarray, first_keys: list[int]) -> Iterator[tuple[int, slice]]:
        """Shards which hold keys of ``distinct`` (rising), with the part of it."""
        cuts = [*np.searchsorted(distinct, first_keys), len(distinct)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                yield i, slice(a, b)

    def pairs(self, distinct: np.ndarray, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Places of distinct pairs (rising) among all pairs, -1 for those not met in training, and their training counts if asked for."""
        place, count = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct) if counted else 0, np.int64)
        for i, part in self._asked(distinct, self.model.first_keys):
            path = f"{self.model.folder}/pairs-{self.model.shards[i]}"
            have = np.memmap(f"{path}.keys", np.int64, "r")
            at = np.minimum(np.searchsorted(have, distinct[part]), len(have) - 1)
            met = have[at] == distinct[part]
            place[part] = np.where(met, at + self.model.places[i], -1)
            if counted:
                count[part] = np.where(met, Counts(path).take(at), 0)
        return place, count

    def pair_places(self, keys: np.ndarray) -> np.ndarray:
        """Places of pairs in any order."""
        distinct, back = np.unique(keys, return_inverse=True)
        return self.pairs(distinct, False)[0][back]

    def _triples(self, i: int) -> tuple[str, int, np.ndarray]:
        """Path of a shard of triples, the place of its first pair, and where the triples of each pair start and end."""
        m = self.model
        path, low = f"{m.folder}/triples-{m.triple_shards[i]}", m.first_triples[i] >> m.word_bits
        n = m.last_places[i] - low + 2
        return path, low, np.memmap(f"{path}.starts", f"u{os.path.getsize(f'{path}.starts') // n}", "r")

    def triple_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of triples."""
        m = self.model
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        for i, part in self._asked(distinct, m.first_triples):
            path, low, starts = self._triples(i)
            words = np.memmap(f"{path}.words", np.uint32, "r")
            place, w = (distinct[part] >> m.word_bits) - low, distinct[part] & ((1 << m.word_bits) - 1)
            inside = np.flatnonzero(place < len(starts) - 1)
            place, w = place[inside], w[inside].astype(np.uint32)
            end = starts[place + 1].astype(np.int64)
            at = _inside(words, starts[place].astype(np.int64), end, w)
            met = np.flatnonzero(at < end)
            met = met[words[at[met]] == w[met]]
            out[part.start + inside[met]] = Counts(path).take(at[met])
        return out[back]

    def left(self, distinct: np.ndarray) -> np.ndarray:
        """What discounts take from the triples that begin with the pairs at these distinct places (rising)."""
        m = self.model
        out, d = np.zeros(len(distinct)), np.array([0.0, *m.d_triple])
        firsts = np.array(m.first_triples, np.int64) >> m.word_bits
        cuts = np.searchsorted(distinct, firsts), np.searchsorted(distinct, np.array(m.last_places, np.int64), side="right")
        for i, (a, b) in enumerate(zip(*cuts)):  # shards can share the pair at their edge
            if a >= b:
                continue
            path, low, starts = self._triples(i)
            at = distinct[a:b] - low
            start = starts[at].astype(np.int64)
            size = starts[at + 1] - start
            many = np.flatnonzero(size > MANY)
            few = np.where(size > MANY, 0, size)
            owner = np.repeat(np.arange(b - a), few)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(few) - few, few) + start[owner]
            small = np.memmap(f"{path}.counts", np.uint8, "r")
            out[a:b] += np.bincount(owner, d[np.minimum(small[inside], 3)], b - a)
            if len(many):
                sums = _file(f"{path}.many", 4)
                out[a + many] += d[1:] @ sums[1:][:, np.searchsorted(sums[0], at[many])]
        return out

    def log_scores(self, w: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token, given by its number: log10 of the model's probability, of the base's, and whether it is known."""
        m = self.model
        known = w >= 0
        safe = np.where(known, w, 0)
        count = np.where(known, self.counts[safe], 0) if m.words else np.zeros(len(w), np.int64)
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        if not m.pairs:
            return np.full(len(w), -np.log10(m.words + 1)), base, known
        a = np.where(known, self.continuations[safe], 0)
        lower = np.maximum(a - _discount(a, m.d_word), 0) / m.pairs + m.word_back / (m.words + 1)
        v = np.r_[-1, w[:-1]]
        v[starts] = m.words
        total = np.where(v >= 0, self.context[np.maximum(v, 0)], 0)
        # What is known of a pair is looked up once per distinct pair; the last one stands for a token without a pair.
        asked = known & (total > 0)
        distinct, back = np.unique((v[asked] << PAIR_BITS) | w[asked], return_inverse=True)
        pair = np.full(len(w), len(distinct), np.int64)
        pair[asked] = back
        places, counts = (np.r_[x, y] for x, y in zip(self.pairs(distinct), (-1, 0)))
        place, met = places[pair], counts[pair]
        c, found = met, np.flatnonzero(places >= 0)
        if m.order > 2:
            before = np.zeros(len(places), np.int64)
            before[found] = _before_counts(m.folder, places[found])
            c = np.where(v == m.words, met, before[pair])
        kept = np.maximum(c - _discount(c, m.d_pair), 0)
        p = np.where(total > 0, kept / np.maximum(total, 1) + np.where(total > 0, self.back[np.maximum(v, 0)], 1.0) * lower, lower)
        if m.order > 2:
            ahead, whole = np.r_[-1, place[:-1]], np.r_[0, met[:-1]]
            ahead[starts], whole[starts] = -1, 0
            c = np.zeros(len(w), np.int64)
            asked = known & (ahead >= 0)
            c[asked] = self.triple_counts((ahead[asked] << m.word_bits) | w[asked])
            left = np.zeros(len(places))
            left[found] = self.left(places[found])
            kept = np.maximum(c - _discount(c, m.d_triple), 0)
            p = np.where(ahead >= 0, (kept + np.r_[0.0, left[pair[:-1]]] * p) / np.maximum(whole, 1), p)
        return np.log10(p), base, known


def _fill(path: str, kind, n: int) -> None:
    with open(path, "wb") as f:
        f.truncate(n * np.dtype(kind).itemsize)


def _replace(path: str, array: np.ndarray) -> None:
    """Write a file as a whole; a reader sees all of it or the one before, which is the same."""
    temporary = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    array.tofile(temporary)
    os.replace(temporary, path)


def _pack(values: np.ndarray) -> bytes:
    """Differences of sorted or small integers, byte plane by byte plane, compressed."""
    steps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def _summed(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of packed blocks in order, with the sums of their counts."""
    key, n = np.concatenate([_unpack(k) for k in keys]), np.concatenate([_unpack(c) for c in counts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def _packed_shards(shard: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row per shard (these rise with the keys): its sorted keys and their counts."""
    cuts = [*np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(key)]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard[cuts[:-1]]), *(pa.array([_pack(x[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in (key, n))],
        names=["shard", "keys", "counts"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """Rows (shard, keys, counts) sorted by shard: what belongs to each shard."""
    current, keys, counts = None, [], []
    for batch in batches:
        for s, k, c in zip(*(x.to_pylist() for x in batch.columns)):
            if current is not None and s != current:
                yield current, keys, counts
                keys, counts = [], []
            current = s
            keys.append(k)
            counts.append(c)
    if current is not None:
        yield current, keys, counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0

    def count() -> pa.RecordBatch:
        h, n = (np.concatenate(x) for x in zip(*parts))
        distinct, back = np.unique(h, return_inverse=True)
        summed = np.zeros(len(distinct), np.int64)
        np.add.at(summed, back, n)
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(summed)], names=["h", "n"])

    for chunk in chunks(batches, CHUNK_BYTES):
        h, place, _ = tokens(chunk.column(0))
        parts.append((h, np.bincount(place, minlength=len(h))))
        held += len(place)
        if held >= COUNT_TOKENS:
            yield count()
            parts, held = [], 0
    if held:
        yield count()


def fit(df: DataFrame, text_column: str = "text", shard_tokens: int = SHARD_TOKENS, order: int = ORDER) -> Model:
    """Count all texts of ``df`` and write the model of order 2 or 3."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 and 3 are built")
    spark = df.sparkSession
    texts = df.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    folder = shared_folder(spark, "pair-model")
    with scratch_tables(spark):
        model = _fit_words(texts, folder, order)
    if model.words:
        with scratch_tables(spark):
            _fit_pairs(spark, texts, model, shard_tokens)
    if os.path.exists(f"{folder}/before"):
        os.remove(f"{folder}/before")  # only for dealing out pairs
    return model


def delete(spark: SparkSession, model: Model) -> None:
    """Remove the files of a model that no DataFrame reads any more."""
    delete_tables(spark, [model.folder])


def _fit_words(texts: DataFrame, folder: str, order: int) -> Model:
    """Count and number the words."""
    shard = F.shiftright("h", 63 - WORD_SHARD_BITS)
    words = stage(texts.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).withColumn("shard", shard), "words")
    sizes = sorted((r.shard, r.rows, r.n) for r in words.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect())
    places, sums, at, mass = {}, {}, 0, 0
    for s, rows, n in sizes:  # 2 ** WORD_SHARD_BITS rows at most
        places[s], sums[s] = at, mass
        at, mass = at + rows, mass + n
    model = Model(folder, at, mass, order=order)
    if not at:
        return model
    if at >= 1 << PAIR_BITS:
        raise ValueError(f"{at} distinct words don't fit {PAIR_BITS} bits")
    for name in ("words", "counts", "before"):
        _fill(f"{folder}/{name}", np.int64, at)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [np.memmap(f"{folder}/{name}", np.int64, "r+") for name in ("words", "counts", "before")]
        written, summed = dict(places), dict(sums)
        for batch in batches:
            s, h, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for one in np.unique(s):
                mine = s == one
                a, one = written[int(one)], int(one)
                part = slice(a, a + int(mine.sum()))
                files[0][part], files[1][part] = h[mine], n[mine]
                files[2][part] = summed[one] + np.cumsum(n[mine]) - n[mine]
                written[one], summed[one] = part.stop, summed[one] + int(n[mine].sum())
        for f in files:
            f.flush()
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["done"])

    stage(words.select("shard", "h", "n").repartition("shard").sortWithinPartitions("h").mapInArrow(write_words, "done long"), "words-written")
    return model


def _fit_pairs(spark: SparkSession, texts: DataFrame, model: Model, shard_tokens: int) -> None:
    """Count pairs, and triples if the order asks for them, write their files, and fill in the model."""
    folder, n_words, n_tokens = model.folder, model.words, model.tokens
    n_shards = n_tokens // shard_tokens + 1

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped, parts, held = Mapped(model), [], 0

        def count() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            v, w = key >> PAIR_BITS, key & ((1 << PAIR_BITS) - 1)
            inner = np.minimum(v, n_words - 1)
            # The share of tokens before this pair, if a word's pairs were spread evenly: rises with the key.
            share = np.where(v < n_words, mapped.before[inner] + mapped.counts[inner] * (w / n_words), n_tokens * 1.0)
            shard = np.minimum((share / n_tokens * n_shards).astype(np.int64), n_shards - 1)
            start = v == n_words  # first words of texts: a context of its own, cut by the second word
            shard[start] = n_shards + (w[start] * (1 + n_shards // 16) // n_words)
            return _packed_shards(shard, key, n)

        for chunk in chunks(batches, CHUNK_BYTES):
            h, place, starts = tokens(chunk.column(0))
            if not len(place):
                continue
            w = mapped.numbers(h)[place]
            v = np.r_[0, w[:-1]]
            v[starts] = n_words
            parts.append((v << PAIR_BITS) | w)
            held += len(w)
            if held >= COUNT_TOKENS:
                yield count()
                parts, held = [], 0
        if held:
            yield count()

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed pairs by shard: files per shard, and rows (kind, id, x1..x4) of what to sum further."""
        def rows(kind: int, ids, *xs) -> pa.RecordBatch:
            full = [np.asarray(x, np.int64) for x in xs] + [np.zeros(len(ids), np.int64)] * (4 - len(xs))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), kind, np.int32)), pa.array(np.asarray(ids, np.int64)), *map(pa.array, full)],
                names=["kind", "id", "x1", "x2", "x3", "x4"])

        for shard, keys, counts in _by_shard(batches):
            key, n = _summed(keys, counts)
            _replace(f"{folder}/pairs-{shard}.keys", key)
            Counts.write(f"{folder}/pairs-{shard}", n)
            _replace(f"{folder}/pairs-{shard}.mass", (np.cumsum(n) - n)[::1 << MASS_BITS])
            v = key >> PAIR_BITS
            at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            yield rows(0, v[at], np.add.reduceat(n, at), *(np.add.reduceat(x.astype(np.int64), at) for x in (n == 1, n == 2, n >= 3)))
            yield rows(1, *np.unique(key & ((1 << PAIR_BITS) - 1), return_counts=True))
            yield rows(2, np.arange(1, 5), [int((n == k).sum()) for k in range(1, 5)])
            yield rows(3, [shard], [len(key)], [int(key[0])], [int(n.sum())])

    dealt = texts.mapInArrow(count_pairs, "shard long, keys binary, counts binary").repartition("shard").sortWithinPartitions("shard")
    sums = stage(dealt.mapInArrow(write_pairs, "kind int, id long, x1 long, x2 long, x3 long, x4 long"), "pairs")
    for name, kind, n in (("continuations", np.int64, n_words), ("context", np.int64, n_words + 1), ("back", np.float64, n_words + 1)):
        _fill(f"{folder}/{name}", kind, n)
    of_counts = {r.id: r.n for r in sums.filter("kind = 2").groupBy("id").agg(F.sum("x1").alias("n")).collect()}
    model.d_pair = d = discounts(of_counts)
    shards = sorted((r.x2, r.id, r.x1, r.x3) for r in sums.filter("kind = 3").collect())  # one short row per file
    model.first_keys, model.shards, model.pairs = [x[0] for x in shards], [x[1] for x in shards], sum(x[2] for x in shards)
    model.places, model.mass = ([0, *accumulate(x[k] for x in shards)][:-1] for k in (2, 3))
    of_words = sums.filter("kind = 0")
    if model.order > 2:
        with scratch_tables(spark):
            of_words, of_counts = _fit_triples(spark, texts, model, shard_tokens)
        model.d_pair = d = discounts(of_counts)

    def write_by_number(*names: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files = [np.memmap(f"{folder}/{name}", np.float64 if name == "back" else np.int64, "r+") for name in names]
            for batch in batches:
                at, *xs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                for f, x in zip(files, xs):
                    f[at] = x
            for f in files:
                f.flush()
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["done"])

        return run

    by_block = F.shiftright("id", 20)
    contexts = of_words.groupBy("id").agg(*[F.sum(f"x{k}").alias(f"x{k}") for k in range(1, 5)])
    back = (F.lit(d[0]) * F.col("x2") + F.lit(d[1]) * F.col("x3") + F.lit(d[2]) * F.col("x4")) / F.col("x1")
    stage(contexts.select("id", "x1", back.alias("back")).repartition(by_block).sortWithinPartitions("id")
          .mapInArrow(write_by_number("context", "back"), "done long"), "contexts-written")
    follow = stage(sums.filter("kind = 1").groupBy("id").agg(F.sum("x1").alias("n")), "continuations")
    stage(follow.repartition(by_block).sortWithinPartitions("id").mapInArrow(write_by_number("continuations"), "done long"), "continuations-written")
    levels = {r.k: r.n for r in follow.groupBy(F.least("n", F.lit(5)).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    model.d_word = e = discounts(levels)
    more = sum(n for k, n in levels.items() if k >= 3)
    model.word_back = (e[0] * levels.get(1, 0) + e[1] * levels.get(2, 0) + e[2] * more) / model.pairs


def _fit_triples(spark: SparkSession, texts: DataFrame, model: Model, shard_tokens: int) -> tuple[DataFrame, dict[int, int]]:
    """Count triples and write their files; rows (id, x1..x4) of first words, and counts of counts, of the level of pairs."""
    folder, n_words, n_tokens, bits = model.folder, model.words, model.tokens, model.word_bits
    n_shards = n_tokens // shard_tokens + 1
    if model.pairs.bit_length() + bits > 63:
        raise ValueError(f"{model.pairs} pairs and {n_words} words don't fit 63 bits")
    ends = [*model.places[1:], model.pairs]

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped, parts, held = Mapped(model), [], 0

        def count() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            share = np.empty(len(key))
            cuts = np.searchsorted(key, np.array([*model.places, model.pairs], np.int64) << bits)
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:  # tokens before the pair, and of the pair's own the share before the word
                    path, at = f"{folder}/pairs-{model.shards[i]}", (key[a:b] >> bits) - model.places[i]
                    blocks, row = np.unique(at >> MASS_BITS, return_inverse=True)
                    inside = (blocks[:, None] << MASS_BITS) + np.arange(1 << MASS_BITS)
                    c = Counts(path).take(np.minimum(inside, ends[i] - model.places[i] - 1))
                    column = at & ((1 << MASS_BITS) - 1)
                    own, ahead = c[row, column], (np.cumsum(c, 1) - c)[row, column]
                    share[a:b] = model.mass[i] + _file(f"{path}.mass")[0][blocks][row] + ahead + own * ((key[a:b] & ((1 << bits) - 1)) / n_words)
            shard = np.minimum((share / n_tokens * n_shards).astype(np.int64), n_shards - 1)
            return _packed_shards(shard, key, n)

        for chunk in chunks(batches, CHUNK_BYTES):
            h, place, starts = tokens(chunk.column(0))
            if not len(place):
                continue
            w = mapped.numbers(h)[place]
            v = np.r_[0, w[:-1]]
            v[starts] = n_words
            place = mapped.pair_places((v << PAIR_BITS) | w)
            key = (np.r_[0, place[:-1]] << bits) | w
            parts.append(np.delete(key, starts))
            held += len(parts[-1])
            if held >= COUNT_TOKENS:
                yield count()
                parts, held = [], 0
        if held:
            yield count()

    def write_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files per shard; rows of counts of counts (kind 2), the file (3), and packed pairs with the words before them (1)."""
        def rows(kind: int, ids, *xs, keys=None, counts=None) -> pa.RecordBatch:
            full = [np.asarray(x, np.int64) for x in xs] + [np.zeros(len(ids), np.int64)] * (2 - len(xs))
            none = [None] * len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), kind, np.int32)), pa.array(np.asarray(ids, np.int64)), *map(pa.array, full),
                 pa.array(keys or none, pa.binary()), pa.array(counts or none, pa.binary())],
                names=["kind", "id", "x1", "x2", "keys", "counts"])

        mapped = Mapped(model)
        for shard, keys, counts in _by_shard(batches):
            key, n = _summed(keys, counts)
            place, w = key >> bits, key & ((1 << bits) - 1)
            at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            low, high, path = int(place[0]), int(place[-1]), f"{folder}/triples-{shard}"
            size = np.zeros(high - low + 2, np.int64)  # pairs without triples have an empty range
            size[place[at] - low + 1] = np.diff(np.r_[at, len(key)])
            _replace(f"{path}.starts", np.cumsum(size).astype(np.min_scalar_type(len(key))))
            _replace(f"{path}.words", w.astype(np.uint32))
            Counts.write(path, n)
            sums = np.stack([place[at] - low, *(np.add.reduceat(x.astype(np.int64), at) for x in (n == 1, n == 2, n >= 3))])
            _replace(f"{path}.many", sums[:, sums[1:].sum(0) > MANY])
            second = np.empty(len(at), np.int64)
            cuts = np.searchsorted(place[at], [*model.places, model.pairs])
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    second[a:b] = np.memmap(f"{folder}/pairs-{model.shards[i]}.keys", np.int64, "r")[place[at][a:b] - model.places[i]]
            v = np.repeat(second & ((1 << PAIR_BITS) - 1), np.diff(np.r_[at, len(key)]))
            pair, times = np.unique(mapped.pair_places((v << PAIR_BITS) | w), return_counts=True)
            block = pair >> PLACE_BLOCK_BITS
            cuts = [*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(pair)]
            for a, b in zip(cuts, cuts[1:]):
                yield rows(1, [block[a]], keys=[_pack(pair[a:b])], counts=[_pack(times[a:b])])
            yield rows(2, np.arange(1, 5), [int((n == k).sum()) for k in range(1, 5)])
            yield rows(3, [shard], [int(key[0])], [high])

    dealt = texts.mapInArrow(count_triples, "shard long, keys binary, counts binary").repartition("shard").sortWithinPartitions("shard")
    sums = stage(dealt.mapInArrow(write_triples, "kind int, id long, x1 long, x2 long, keys binary, counts binary"), "triples")
    model.d_triple = discounts({r.id: r.n for r in sums.filter("kind = 2").groupBy("id").agg(F.sum("x1").alias("n")).collect()})
    found = sorted((r.x1, r.id, r.x2) for r in sums.filter("kind = 3").collect())  # one short row per file
    model.first_triples, model.triple_shards, model.last_places = ([x[k] for x in found] for k in range(3))

    def write_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys, counts in _by_shard(batches):
            low = block << PLACE_BLOCK_BITS
            whole = np.zeros(min(1 << PLACE_BLOCK_BITS, model.pairs - low), np.int64)
            for k, c in zip(keys, counts):
                whole[_unpack(k) - low] += _unpack(c)
            Counts.write(f"{folder}/before-{block}", whole)
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], names=["done"])

    stage(sums.filter("kind = 1").select("id", "keys", "counts").repartition("id").sortWithinPartitions("id").mapInArrow(write_before, "done long"), "before-written")

    def sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per first word of a file of pairs: the sum of the counts of its level, and how many are 1, 2, more; counts of counts under -k."""
        for batch in batches:
            for i in batch.column(0).to_pylist():
                path = f"{folder}/pairs-{model.shards[i]}"
                v = np.fromfile(f"{path}.keys", np.int64) >> PAIR_BITS
                n = np.where(v == n_words, Counts(path).take(np.arange(len(v))), _before_counts(folder, np.arange(model.places[i], ends[i])))
                at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
                xs = [np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n >= 3)]
                levels = np.array([int((n == k).sum()) for k in range(1, 5)])
                columns = [np.r_[v[at], -np.arange(1, 5)], np.r_[xs[0], levels], *(np.r_[x, np.zeros(4, np.int64)] for x in xs[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "x1", "x2", "x3", "x4"])

    files = spark.range(0, len(model.shards), 1, len(model.shards))
    both = stage(files.mapInArrow(sum_pairs, "id long, x1 long, x2 long, x3 long, x4 long"), "pair-level", outlives=True)
    levels = {-r.id: r.n for r in both.filter("id < 0").groupBy("id").agg(F.sum("x1").alias("n")).collect()}
    return both.filter("id >= 0"), levels


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, base_score, score (log10 of the probability of the text and its end)."""
    kind = df.schema[id_column].dataType.simpleString()
    given = df.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = Mapped(model)
        for chunk in chunks(batches, CHUNK_BYTES // 2):
            if not chunk.num_rows:
                continue
            h, place, starts = tokens(chunk.column(1))
            p, base, known = mapped.log_scores(mapped.numbers(h)[place], starts)
            n = np.diff(np.r_[starts, len(place)])
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(n), *(pa.array(np.add.reduceat(x, starts)) for x in (known.astype(np.int64), base, p))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return given.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def train_and_score(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 5, held: int = 1, order: int = ORDER,
) -> DataFrame:
    """Learn from the rows outside the held-out fold (CRC-32 of the id as text) and score all rows.

    Null texts are empty and still end. A null id is an empty text for the fold. Without training rows every token has the
    same probability. ``perplexity`` is 10 ** (-score / n_tokens).
    """
    fold = F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).cast("binary")) % folds
    model = fit(df.filter(fold != held), text_column, order=order)
    id_fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    return score(df, model, id_column, text_column).select(
        "doc_id", (id_fold == held).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
