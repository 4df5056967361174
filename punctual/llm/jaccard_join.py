"""Similarity join of shingle sets by inverted lists with block skips, and answers derived from similar sets.

A set is the distinct word shingles of a text as 64-bit hashes. Equal sets are one class (a 128-bit digest), so copies
never meet each other. Classes are joined by prefix filtering: in an order of shingles which puts common ones
last, two sets that link share one of their first ``n - ceil(t n) + 1`` shingles.

Skips in the lists. The entries of a list are sorted by set size and cut into blocks whose sizes can still link with
the first entry, the leader; position and size bound the overlap, and entries beyond the bound are skipped. Most sets of a short
list share that shingle by chance; an entry that no other set of its list could link with is left out before anything is looked up for it.

Derived answers. Members of a block are compared with its first ``LEADERS`` sets only: by sketches with the ``LIKELY`` of them
that share most listed shingles, and by full sets with the ``BEST`` of these. That gives links, and a distance (size of the symmetric difference) from a member to its leader. Members linked with
the same leader are in one component, so nothing is asked of them again. Two members left in different components
can link only if their distances to the common leader differ by no more than their allowed distance; all of those
are compared. So a group of thousands of near copies costs a few comparisons each, and no link between components is missed.

Before full sets are compared, a parity sketch of ``SKETCH_BITS`` bits bounds their distance from below: each differing shingle flips
one bit, so sets with more differing bits than they may have differing shingles can't link.

Orders and lookups by a broadcast array have a fixed size (``2 ** bits`` bytes); they change costs, not results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import WordHashes, binaries, chunks, dense_bytes, lower_words, mix
from punctual.llm.components import components
from punctual.staging import scratch_tables, stage

WORDS = 3
PERCENT = 90
ORDER_BITS = 22
CHUNK_BYTES = 8 << 20
#: Shingles per chunk of the frequency pass.
COUNT_CHUNK = 2_000_000
RANKS_PER_DOUBLING = 8
LEADERS, LIKELY, BEST = 24, 6, 3
#: Rows behind an entry of a list with which it is compared before it is kept.
NEIGHBOURS = 8
SKETCH_BITS = 2048
#: Smallest tokens of a set in lists of several components, by which a pair met in several lists is told once.
EARLY = 16


def shingle_set(text: bytes, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle of all its words; without words, empty."""
    h = hashes.of(lower_words(text))
    if not len(h):
        return h
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def needed(a, b, percent: int):
    """Smallest overlap with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def _needed(a: Column, b: Column, percent: int) -> Column:
    return F.call_function("div", F.lit(percent) * (a + b) + (99 + percent), F.lit(100 + percent)).cast("long")


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each slot, as 64-bit words."""
    odd = np.bincount((s & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differing(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda acc, n: acc + n)


def _slot(token: np.ndarray, bits: int) -> np.ndarray:
    return (token >> np.uint64(64 - bits)).astype(np.int64)


class _Emitter:
    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.names, self.types = names, types

    def __call__(self, *columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.types)], names=self.names)


def _frequent(words: int):
    """Shingles that occur in two or more texts of a chunk, with their number there."""
    emit = _Emitter(["token", "n"], [pa.int64(), pa.int64()])

    def count(parts: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(parts), return_counts=True)
        return emit(token[n > 1].view(np.int64), n[n > 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, parts, held = WordHashes(), [], 0
        for chunk in chunks(batches, CHUNK_BYTES):
            for text in binaries(chunk.column(0)):
                parts.append(shingle_set(text, hashes, words))
                held += len(parts[-1])
                if held >= COUNT_CHUNK:
                    yield count(parts)
                    parts, held = [], 0
        if parts:
            yield count(parts)

    return run


def shingle_ranks(df: DataFrame, text: str, words: int, bits: int) -> np.ndarray:
    """One byte per slot of shingles: the logarithm of how often its most frequent shingle was met."""
    counted = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(_frequent(words), "token long, n long") \
        .groupBy("token").agg(F.sum("n").alias("n"))
    slots = counted.select(
        F.shiftrightunsigned("token", 64 - bits).alias("slot"),
        F.least(F.floor(F.log2("n") * RANKS_PER_DOUBLING), F.lit(255)).cast("int").alias("value"),
    )
    return dense_bytes(slots, bits)


def _sets(words: int, percent: int, ranks, bits: int):
    """Digest, size and sketch of each row's set; its prefix too, once per distinct set of a chunk."""
    width = SKETCH_BITS // 64

    def lists(parts: list[np.ndarray | None]) -> pa.Array:
        ends = np.cumsum([0, *(0 if x is None else len(x) for x in parts)], dtype=np.int32)
        offsets = pa.array(ends, mask=np.array([*(x is None for x in parts), False]))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *(x for x in parts if x is not None)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in chunks(batches, CHUNK_BYTES):
            seen, digests, sizes, sketches, prefixes = set(), [], [], [], []
            for text in binaries(chunk.column(1)):
                s = shingle_set(text, hashes, words)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                digests.append(digest)
                sizes.append(len(s))
                sketches.append(sketch(s))
                if len(s) and digest not in seen:
                    seen.add(digest)
                    order = np.lexsort((s, ranks.value[_slot(s, bits)]))[:prefix_length(len(s), percent)]
                    prefixes.append(s[order].view(np.int64))
                else:
                    prefixes.append(None)
            packed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sketches) + 1, dtype=np.int32) * width), pa.array(np.concatenate(sketches) if sketches else [], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), packed, lists(prefixes)],
                names=["id", "digest", "n", "sketch", "prefix"])

    return run


def _partners(token: np.ndarray, size: np.ndarray, room: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in order of token and size: whether a set has another in its list that could link by size; by size and place.

    Sizes rise in a list, so a set that can't link with its neighbour can't link beyond it. Places are compared up to
    ``NEIGHBOURS`` rows away; where sizes could link at that distance, places are left out.
    """
    by_size, by_place = np.zeros(len(token), bool), np.zeros(len(token), bool)
    for k in range(1, min(NEIGHBOURS, len(token) - 1) + 1):
        a, b = size[:-k], size[k:]
        fits = (token[k:] == token[:-k]) & (percent * b <= 100 * a)
        if k == 1:
            by_size[:-1] |= fits
            by_size[1:] |= fits
        if k < NEIGHBOURS:
            fits &= np.minimum(room[:-k], room[k:]) >= needed(a, b, percent)
        by_place[:-k] |= fits
        by_place[k:] |= fits
    return by_size, by_place


def _lists(percent: int):
    """Sorted postings -> entries that another set of their list could link with, each with the leaders of its block which the bound lets through."""
    emit = _Emitter(["token", "digest", "size", "place", "leader", "leaders"],
                    [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, np.zeros((2, 0), bool)  # the last rows, until those behind them are known; what is known of them
        leader: tuple = (None, [])  # token and leaders of the block
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, size, place = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2, 3))
            digest = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, 2)
            # The same set from another chunk stands beside itself.
            rows = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (digest[1:] != digest[:-1]).any(1)])
            known = np.stack(_partners(token[rows], size[rows], (size - place)[rows], percent))
            known[:, :before.shape[1]] |= before
            n = max(0, len(rows) - NEIGHBOURS)
            held, before = batch.take(pa.array(rows[n:])), known[:, n:]
            entries, leader = _entries(batch, rows[:n], known[:, :n], leader, percent)
            if entries:
                yield emit(*zip(*entries))
        if held is not None:
            entries, _ = _entries(held, np.arange(held.num_rows), before, leader, percent)
            if entries:
                yield emit(*zip(*entries))

    return run


def _entries(batch: pa.RecordBatch, rows: np.ndarray, known: np.ndarray, leader, percent: int):
    """Rows with a partner by size make up blocks and their leaders; those with a partner by place too are entries."""
    by_size, by_place = known
    entries, take = [], batch.take(pa.array(rows[by_size]))
    for t, digest, size, place, wanted in zip(*(c.to_pylist() for c in take.columns), by_place[by_size].tolist()):
        heads = leader[1] if t == leader[0] else []
        if heads and percent * size > 100 * heads[0][1]:
            heads = []
        near = [h for h, s, at in heads if 1 + min(s - at - 1, size - place - 1) >= needed(s, size, percent)] if wanted else []
        if len(heads) < LEADERS:
            heads.append((digest, size, place))
        if wanted:
            entries.append((t, digest, size, place, heads[0][0], near))
        leader = (t, heads)
    return entries, leader


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, CHUNK_BYTES):
        x, y = (batch.column(i).to_pylist() for i in (2, 3))
        common = [len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)) for a, b in zip(x, y)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64())], names=["a", "b", "common"])


class SetJoin:
    """``rows`` (written): id, digest, n. ``classes``: digest, n, class_id. ``links``: a, b. ``labels``: digest, label."""

    def __init__(self, rows: DataFrame, classes: DataFrame, links: DataFrame, labels: DataFrame):
        self.rows, self.classes, self.links, self.labels = rows, classes, links, labels


class _Join:
    def __init__(self, docs: DataFrame, words: int, percent: int, bits: int):
        self.docs, self.words, self.percent, self.bits = docs, words, percent, bits
        self.sc = docs.sparkSession.sparkContext

    def screened(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs (a, b, n_a, n_b, low) whose sketches don't rule a link out."""
        side = lambda k: classes.select(
            F.col("digest").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
        low = _differing(F.col("s_a"), F.col("s_b"))
        both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        may = F.col("n_a") + F.col("n_b") - 2 * _needed(F.col("n_a"), F.col("n_b"), self.percent)
        return both.withColumn("low", low).filter(F.col("low") <= may).select("a", "b", "n_a", "n_b", "low")

    def verified(self, pairs: DataFrame, classes: DataFrame, label: str) -> DataFrame:
        """Overlap of each pair (a, b, n_a, n_b), written. Sets are made again from the texts of the classes' first rows."""
        wanted = stage(
            pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct().join(classes.select("digest", "class_id"), "digest")
            .filter(F.col("class_id").isNotNull()), f"{label}-wanted",
        )
        slot = F.shiftrightunsigned(F.xxhash64("class_id"), 64 - self.bits)
        flags = self.sc.broadcast(dense_bytes(wanted.select(slot.alias("slot"), F.lit(1).alias("value")), self.bits))
        words = self.words

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for chunk in chunks(batches, CHUNK_BYTES):
                chunk = chunk.filter(pa.array(flags.value[chunk.column(2).to_numpy(zero_copy_only=False)] > 0))
                sets = [shingle_set(x, hashes, words).tobytes() for x in binaries(chunk.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())],
                    names=["class_id", "digest", "tokens"])

        kind = self.docs.schema["id"].dataType.simpleString()
        given = self.docs.filter(F.col("id").isNotNull()).select("id", "text", F.shiftrightunsigned(F.xxhash64("id"), 64 - self.bits).alias("slot"))
        made = given.mapInArrow(make, f"class_id {kind}, digest binary, tokens binary").join(
            wanted.select("digest", "class_id"), ["digest", "class_id"], "left_semi")
        sets = stage(made.select("digest", "tokens"), f"{label}-sets")
        both = pairs.select("a", "b").join(sets.withColumnsRenamed({"digest": "b", "tokens": "tokens_b"}), "b").join(
            sets.withColumnsRenamed({"digest": "a", "tokens": "tokens_a"}), "a").select("a", "b", "tokens_a", "tokens_b")
        common = both.mapInArrow(_overlaps, "a binary, b binary, common long").groupBy("a", "b").agg(F.max("common").alias("common"))
        return stage(common.join(pairs.select("a", "b", "n_a", "n_b"), ["a", "b"]), f"{label}-verified")

    def linked(self, verified: DataFrame) -> DataFrame:
        return verified.filter(100 * F.col("common") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")

    def run(self) -> SetJoin:
        p = self.percent
        ranks = self.sc.broadcast(shingle_ranks(self.docs, "text", self.words, self.bits))
        kind = self.docs.schema["id"].dataType.simpleString()
        made = stage(
            self.docs.select("id", "text").mapInArrow(
                _sets(self.words, p, ranks, self.bits), f"id {kind}, digest binary, n long, sketch array<long>, prefix array<long>"), "set-rows")
        rows = made.select("id", "digest", "n")
        classes = stage(made.filter("n > 0").groupBy("digest").agg(
            F.first("n").alias("n"), F.min("id").alias("class_id"), F.first("sketch").alias("sketch")), "set-classes")
        postings = made.filter(F.col("prefix").isNotNull()).select(
            F.posexplode("prefix").alias("place", "token"), "digest", F.col("n").cast("int").alias("size")).select("token", "digest", "size", "place")
        lists = stage(
            postings.repartition("token").sortWithinPartitions("token", "size", "digest")
            .mapInArrow(_lists(p), "token long, digest binary, size int, place int, leader binary, leaders array<binary>"), "set-lists",
        )
        shared = lists.select(F.explode("leaders").alias("a"), F.col("digest").alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
        likeliest = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
        led = shared.withColumn("k", likeliest).filter(F.col("k") <= LIKELY)
        nearest = F.row_number().over(Window.partitionBy("b").orderBy("low", "a"))
        near = stage(self.screened(led, classes).withColumn("k", nearest).filter(F.col("k") <= BEST).drop("k"), "set-pairs")
        first = self.verified(near, classes, "set-leaders")
        links = self.linked(first)
        labels = components(links)
        rest = self._across(lists, first, labels, classes).join(first.select("a", "b"), ["a", "b"], "left_anti").join(
            first.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        rest = stage(self.screened(rest, classes), "set-pairs-across")
        if not rest.isEmpty():
            links = stage(links.unionByName(self.linked(self.verified(rest, classes, "set-across"))), "set-links")
            labels = components(links)
        return SetJoin(rows, classes, links, labels.select(F.col("node").alias("digest"), "label"))

    def _across(self, lists: DataFrame, first: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs of a list that are in different components and aren't ruled out by their distances to a common leader."""
        return self._listed_pairs(lists, first, labels, classes).distinct()

    def _listed_pairs(self, lists: DataFrame, first: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
        """These pairs as the lists give them: a pair comes from its first common token, and from later ones only where ``EARLY`` tokens don't tell."""
        p = self.percent
        known = stage(
            lists.select("token", "digest", "size", "place", "leader").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
            .select("token", "digest", F.col("size").cast("long").alias("size"), F.col("place").cast("long").alias("place"), "leader",
                    F.coalesce("label", "digest").alias("label")), "set-known")
        per_label = known.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
        mixed = per_label.groupBy("token").agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")) \
            .filter("labels > 1").select("token", F.col("most.label").alias("most"))
        listed = stage(known.join(mixed, "token"), "set-mixed")
        # Half of the sketch's width is enough here: parities of two slots together are a sketch too.
        half = SKETCH_BITS // 128
        folded = F.transform(F.sequence(F.lit(0), F.lit(half - 1)), lambda i: F.get("sketch", i).bitwiseXOR(F.get("sketch", i + half)))
        # What is known of a set (its sketch, its first tokens, its distances to at most ``BEST`` leaders) meets its entries in one join.
        distances = first.groupBy(F.col("b").alias("digest")).agg(
            F.collect_list(F.struct(F.col("a").alias("leader"), (F.col("n_a") + F.col("n_b") - 2 * F.col("common")).alias("far"))).alias("far"))
        early = listed.groupBy("digest").agg(F.slice(F.array_sort(
            F.collect_list(F.struct("token", (F.col("size") - F.col("place")).alias("room")))), 1, EARLY).alias("early"))
        of_set = early.join(classes.select("digest", folded.alias("sketch")), "digest").join(distances, "digest", "left")
        to_leader = F.filter("far", lambda d: d.leader == F.col("leader"))
        entries = listed.join(of_set, "digest").select(
            *listed.columns, "sketch", "early",
            F.when(F.col("leader") == F.col("digest"), F.lit(0).cast("long")).otherwise(F.get(to_leader, F.lit(0)).far).alias("far"),
        )
        few, all_ = entries.filter("label <> most").alias("x"), entries.alias("y")
        x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
        need = _needed(x("size"), y("size"), p)
        bound = 1 + F.least(x("size") - x("place"), y("size") - y("place")) - 1
        ruled_out = F.coalesce(
            (x("leader") == y("leader")) & (F.abs(x("far") - y("far")) > x("size") + y("size") - 2 * need), F.lit(False))
        low = _differing(x("sketch"), y("sketch"))
        # The bound asks for the same of every token, so the least of those that meet it tells the pair; linked sets have one.
        roomy = lambda c: F.transform(F.filter(c("early"), lambda e: (e.token < x("token")) & (e.room >= need)), lambda e: e.token)
        told = F.arrays_overlap(roomy(x), roomy(y))
        once = (y("label") == y("most")) | (x("digest") < y("digest"))
        fits = once & (bound >= need) & ~ruled_out & (low <= x("size") + y("size") - 2 * need)
        pairs = few.join(all_, (x("token") == y("token")) & (x("label") != y("label")) & fits & ~told)
        return pairs.select(F.least(x("digest"), y("digest")).alias("a"), F.greatest(x("digest"), y("digest")).alias("b"))


def set_join(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT, bits: int = ORDER_BITS,
) -> SetJoin:
    """Join the shingle sets of all texts.

    Null and empty texts, and texts of white space, have no set and no link. Rows without an id are linked by equal sets only
    if no row of their class has an id (there is no row to name). Repeated rows are members of the same class.
    """
    docs = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return _Join(docs, words, percent, bits).run()


def near_components(join: SetJoin) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, n_links (of its class, to other classes), component_id."""
    degrees = join.links.select(F.col("a").alias("digest")).union(join.links.select("b")).groupBy("digest").agg(F.count(F.lit(1)).alias("n_links"))
    named = join.classes.join(join.labels, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    smallest = named.groupBy("label").agg(F.min("class_id").alias("component_id"))
    by_digest = named.join(smallest, "label").join(degrees, "digest", "left").select("digest", "class_id", "n_links", "component_id")
    return join.rows.join(by_digest, "digest", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
    )


def one_of_each(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """The rows whose id is the smallest of their component, with the columns that came in.

    Rows without words stay. Rows without an id stay too: nothing tells them apart. Where an id is on several rows
    of one component, all of them stay (the same text twice under one id is for exact deduplication).
    """
    with scratch_tables(df.sparkSession):
        found = near_components(set_join(df, id_column, text_column, words, percent))
        dropped = stage(
            found.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays")).filter("stays = 0").select("doc_id"),
            "near-dropped", outlives=True,
        )
    return df.join(dropped.withColumnRenamed("doc_id", "_dropped"), F.col(f"`{id_column}`") == F.col("_dropped"), "left_anti")
