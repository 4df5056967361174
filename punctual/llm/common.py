"""Small helpers of this subpackage: words of a text, 64-bit mixing, dense arrays of bounded size, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the contracts, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

BLOCK_BITS = 12
WORD_CACHE = 300_000


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


class WordHashes(dict):
    """64-bit hashes of words; the cache is emptied when it has grown to ``WORD_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case (bytes methods leave all else alone)."""
    return text.lower().split()


def binaries(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return column.fill_null("").cast(pa.large_binary()).to_pylist() if pa.types.is_large_string(column.type) \
        else column.fill_null("").cast(pa.binary()).to_pylist()


def chunks(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``max_bytes`` (one row at least), so that memory doesn't follow the length of texts."""
    for batch in batches:
        rows = max(1, min(batch.num_rows, int(batch.num_rows * max_bytes / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def dense_bytes(slots: DataFrame, bits: int) -> np.ndarray:
    """Array of ``2 ** bits`` bytes with the largest ``value`` of each ``slot``; other slots are 0.

    What reaches the driver is bounded by the array's own size, whatever the input.
    """
    width = 1 << BLOCK_BITS

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            slot, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.argsort(slot, kind="stable")
            slot, value = slot[order], value[order]
            block = slot >> BLOCK_BITS
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
            for a, b in zip(starts, [*starts[1:], len(block)]):
                part = found.setdefault(int(block[a]), np.zeros(width, np.uint8))
                np.maximum.at(part, slot[a:b] & (width - 1), value[a:b].astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())],
            names=["block", "bytes"],
        )

    packed = (
        slots.groupBy("slot").agg(F.max("value").cast("int").alias("value")).select("slot", "value")
        .withColumn("block", F.shiftright("slot", BLOCK_BITS)).repartition("block").select("slot", "value")
        .mapInArrow(blocks, "block long, bytes binary")
    )
    out = np.zeros(1 << bits, np.uint8)
    for row in packed.collect():
        out[row.block * width:(row.block + 1) * width] = np.frombuffer(row.bytes, np.uint8)
    return out
