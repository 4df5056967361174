"""Exact deduplication by Grace hashing: partition, spill what doesn't fit, partition the spilled rows again.

Texts are equal when they are identical after every run of white space became one space. Tables use
open addressing on a 64-bit hash and compare complete contents, so no hash collision can join two texts.

1. Each task combines its own rows in a table over a bounded chunk: one representative row (smallest id) for
   each distinct text, and one short row for each member. Copies of a hot text shrink to one row per chunk
   before anything is shuffled. Both go to a written table, which also freezes the numbers given to them.
2. Representatives are dealt out by a hash of their text. A task keeps distinct texts in its table up to
   ``table_bytes``; once it is full, equal texts still meet their entry and all other rows are spilled to
   a written table, which the next round deals out by other bits of the hash. Copies never fill a table.
3. Members get their group by the number of their representative; no group is ever gathered.

Where the rows that stay are wanted, a task takes its rows by hash and id. The first of equal texts is then the one that stays, and
goes out with its other columns as it is met, so that no text moves a second time.
"""

from __future__ import annotations

import hashlib
import itertools
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from punctual.llm.common import binaries, chunks
from punctual.staging import stage

CHUNK_BYTES = 32 << 20
TABLE_BYTES = 64 << 20
#: Rows with their texts go out of a task in parts of this size.
PART_BYTES = 4 << 20
#: Texts that are made Python objects at a time.
TEXT_ROWS = 256
NUMBER_BITS = 36
_SPACES = frozenset(b" \t\n\x0b\x0c\r")


def normalise(text: bytes) -> bytes:
    """Each run of white space as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    body = b" ".join(words)
    return (b" " if text[0] in _SPACES else b"") + body + (b" " if text[-1] in _SPACES else b"")


def _texts(column: pa.Array) -> Iterator[bytes]:
    for start in range(0, len(column), TEXT_ROWS):
        yield from binaries(column.slice(start, TEXT_ROWS))


class OpenTable:
    """Open addressing with linear probing; entries are numbered in the order in which they came."""

    def __init__(self) -> None:
        self.slots = array("q", [-1]) * 1024
        self.hashes = array("Q")
        self.texts: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, text: bytes) -> int:
        """The entry with this content, or ``-1 - slot`` of the free slot where it would go."""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == h and self.texts[entry] == text:
                return entry
            at = (at + 1) & mask
        return -1 - at

    def add(self, h: int, text: bytes, free: int) -> int:
        entry = len(self.texts)
        self.slots[-1 - free] = entry
        self.hashes.append(h)
        self.texts.append(text)
        self.bytes += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self.slots = array("q", [-1]) * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for i, other in enumerate(self.hashes):
                at = other & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i
        return entry


def _before(a: tuple, b: tuple) -> bool:
    """Order of (id, number) with missing ids last."""
    return (a[0] is None, 0 if a[0] is None else a[0], a[1]) < (b[0] is None, 0 if b[0] is None else b[0], b[1])


def _combine(chunk_bytes: int, kind: T.DataType):
    id_type = to_arrow_type(kind)
    names = ["rep", "number", "id", "hash", "size", "sha", "first", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << NUMBER_BITS
        for chunk in chunks(batches, chunk_bytes):
            row = chunk.column(1)
            table, ids = OpenTable(), chunk.column(0).to_pylist()
            best: list[int] = []
            size: list[int] = []
            digests: list[bytes] = []
            entries = []
            for i, text in enumerate(_texts(row.field("text"))):
                text = normalise(text)
                digest = hashlib.sha256(text).digest()
                h = int.from_bytes(digest[:8], "big")
                entry = table.find(h, text)
                if entry < 0:
                    entry = table.add(h, text, entry)
                    best.append(i)
                    size.append(0)
                    digests.append(digest)
                elif _before((ids[i], i), (ids[best[entry]], best[entry])):
                    best[entry] = i
                size[entry] += 1
                entries.append(entry)
            del table  # what goes out is taken from the rows
            n, m = len(ids), len(best)
            first = [best[e] == i for i, e in enumerate(entries)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * n), pa.array([number + e for e in entries], pa.int64()), chunk.column(0), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.array([digests[e].hex() for e in entries], pa.string()), pa.array(first, pa.bool_()),
                 pa.nulls(n, row.type)], names=names,
            )
            step = max(1, m * PART_BYTES // max(1, chunk.nbytes))
            for a in range(0, m, step):
                at = best[a:a + step]
                k = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([True] * k), pa.array(range(number + a, number + a + k), pa.int64()), pa.array([ids[i] for i in at], id_type),
                     pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests[a:a + k]], pa.int64()),
                     pa.array(size[a:a + k], pa.int64()), pa.nulls(k, pa.string()), pa.nulls(k, pa.bool_()),
                     row.take(pa.array(at, pa.int64()))], names=names,
                )
            number += m

    return run


def _resolve(table_bytes: int, schema: pa.Schema, with_rows: bool):
    """Rows of one task: (number, id, hash, size, text, rest) -> groups, rows that stay, and spilled rows as they came."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        numbers, entries = array("q"), array("q")
        best: list[tuple] = []
        total = array("q")

        def out(kind, number, keep, group, winner, like=None):
            n = len(number)
            cols = [like.column(i) for i in range(1, 6)] if like is not None else [
                pa.nulls(n, schema.field(k).type) for k in ("id", "hash", "size", "text", "rest")]
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.string()), pa.array(number, pa.int64()),
                 pa.array(keep, schema.field("id").type), pa.array(group, pa.int64()), pa.array(winner, pa.bool_()), *cols],
                names=["kind", "number", "keep_id", "group_size", "winner", "id", "hash", "size", "text", "rest"],
            )

        def passed(kind, batch, places):
            took = batch.take(pa.array(places, pa.int64()))
            none = [None] * len(places)
            return out(kind, took.column(0), none, none, none, took)

        for batch in chunks(batches, PART_BYTES):
            spill, stays = [], []
            number, ids, hashes, sizes = (batch.column(i).to_pylist() for i in range(4))
            for i, text in enumerate(binaries(batch.column(4))):
                text = normalise(text)
                h = hashes[i] & 0xFFFFFFFFFFFFFFFF
                entry = table.find(h, text)
                if entry < 0:
                    if table.texts and table.bytes + len(text) > table_bytes:
                        table.bytes = table_bytes  # full from here on: a text is held or spilled as a whole
                        spill.append(i)
                        continue
                    entry = table.add(h, text, entry)
                    best.append((ids[i], number[i]))
                    total.append(0)
                    stays.append(i)
                elif _before((ids[i], number[i]), best[entry]):
                    best[entry] = (ids[i], number[i])
                total[entry] += sizes[i]
                numbers.append(number[i])
                entries.append(entry)
            if spill:
                yield passed("spilled", batch, spill)
            if stays and with_rows:
                yield passed("row", batch, stays)
        step = 50_000
        for a in range(0, len(numbers), step):
            part, of = numbers[a:a + step], entries[a:a + step]
            yield out("group", part, [best[e][0] for e in of], [total[e] for e in of],
                      [best[e][1] == x for x, e in zip(part, of)])

    return run


class Deduplicated:
    """``members``: one row per input row (id, keep_id, group_size, kept, text_sha256); ``kept_rows``: the input rows that stay, if asked for."""

    def __init__(self, members: DataFrame, kept_rows: DataFrame | None):
        self.members, self.kept_rows = members, kept_rows


def exact_dedup(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_rows: bool = True,
    chunk_bytes: int = CHUNK_BYTES, table_bytes: int = TABLE_BYTES,
) -> Deduplicated:
    """Find equal texts; the row with the smallest id of each stays.

    A null text counts as empty, and empty texts are equal to each other. Rows without an id come last, so one of
    them stays only where no row of the group has an id (``keep_id`` is then null). Of repeated rows (same id and
    text) one stays. Other columns, of whatever name, are carried along and not looked at. Rounds end, since each
    takes ``table_bytes`` of distinct texts (one text at least) out of every task.
    """
    kind = df.schema[id_column].dataType
    text = F.col(f"`{text_column}`").cast("string")
    others = [c for c in df.columns if c != text_column] if with_rows else []
    rest = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)])
    # A null text is told from an empty one by the text itself, which goes along as it is, and once: batches of texts fill a task's memory.
    given = df.select(F.col(f"`{id_column}`").alias("id"), F.struct(text.alias("text"), rest.alias("rest")).alias("row"))
    out = T.StructType([
        T.StructField("rep", T.BooleanType()), T.StructField("number", T.LongType()), T.StructField("id", kind),
        T.StructField("hash", T.LongType()), T.StructField("size", T.LongType()), T.StructField("sha", T.StringType()),
        T.StructField("first", T.BooleanType()), T.StructField("row", given.schema["row"].dataType),
    ])
    combined = stage(given.mapInArrow(_combine(chunk_bytes, kind), out), "dedup-combined")
    rest_kind = combined.schema["row"].dataType["rest"].dataType  # as read again: every field may be null
    arrow = _arrow(kind, rest_kind)
    reps = combined.filter("rep")
    waiting = reps.select("number", "id", "hash", "size", "row.text", "row.rest")
    resolved_type = T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("number", T.LongType()), T.StructField("keep_id", kind),
        T.StructField("group_size", T.LongType()), T.StructField("winner", T.BooleanType()), T.StructField("id", kind),
        T.StructField("hash", T.LongType()), T.StructField("size", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("rest", rest_kind),
    ])
    groups = kept = None
    for depth in itertools.count():
        dealt = waiting.repartition(F.xxhash64("hash", F.lit(depth)))
        if with_rows:
            dealt = dealt.sortWithinPartitions("hash", F.asc_nulls_last("id"), "number")
        level = stage(dealt.mapInArrow(_resolve(table_bytes, arrow, with_rows), resolved_type), f"dedup-round-{depth}")
        done = level.filter("kind = 'group'").select("number", "keep_id", "group_size", "winner")
        rows = level.filter("kind = 'row'").select(*[
            (F.col("text") if c == text_column else F.col(f"rest._{others.index(c)}")).cast(df.schema[c].dataType).alias(c) for c in df.columns]) if with_rows else None
        groups, kept = (done, rows) if groups is None else (groups.unionByName(done), kept.union(rows) if with_rows else None)
        waiting = level.filter("kind = 'spilled'").select("number", "id", "hash", "size", "text", "rest")
        if waiting.isEmpty():
            break
    members = combined.filter(~F.col("rep")).select("number", "id", "sha", "first").join(groups, "number").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("first") & F.col("winner")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return Deduplicated(members, kept)


def _arrow(kind: T.DataType, rest: T.DataType) -> pa.Schema:
    return pa.schema([("id", to_arrow_type(kind)), ("hash", pa.int64()), ("size", pa.int64()), ("text", pa.string()), ("rest", to_arrow_type(rest))])
