"""Language by compression: a text is encoded with a zstandard dictionary of each language, and the smallest encoding names it.

A dictionary is raw content: pieces of texts of that language, in the order of their hashes. Texts and dictionaries are prepared
alike: lower case, one space for whatever is no letter, a word repeated at once written once. A text is encoded in pieces of
``CHUNK_BYTES``, each with the dictionary anew, so that the end of a long text counts as much as its beginning. Each piece is
led by the same spaces, since zstandard stores a block raw that it can't shorten, and short texts would all get the same size.

The dictionaries come from a bounded sample: about ``SAMPLE_TEXTS`` training texts per language, chosen by hash, taken whole, of
whose distinct pieces ``DICTIONARY_BYTES`` are kept per language. Languages are few: their names and counts reach the driver.

Rows: null texts and texts without a letter give ``und`` with a score of 0, as does every text where there is nothing to learn
from. A null ``doc_id`` counts as an empty one. Equal sizes go to the language with more training texts, then to the smaller name.
Repeated rows are judged one by one, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import chunks, text_or_empty

SAMPLE_TEXTS = 256
DICTIONARY_BYTES = 16_384
PIECE_CHARS = 256
CHUNK_BYTES = 2048
LEVEL = 6
LEAD = b" " * 64

#: Bytes of difference between two sizes that make one language e times likelier.
TEMPERATURE = 4.0
#: A prediction is rejected if the second size is not larger by this share of the first.
MARGIN = 0.02
UNKNOWN = "und"
HELD_OUT_OF, HELD_OUT = 4, 2

_OTHER = re.compile(r"[\W\d_]+")
_BATCH_BYTES = 16 << 20


def held_out() -> Column:
    return F.crc32(text_or_empty("doc_id").cast("binary")) % HELD_OUT_OF == HELD_OUT


def prepared(text: str) -> str:
    """Words of letters in lower case with a space behind each; empty if there is no letter."""
    words = _OTHER.sub(" ", text.lower()).split()
    kept = [w for w, before in zip(words, chain([""], words)) if w != before]
    return " ".join(kept) + " " if any(c.isalpha() for w in kept for c in w) else ""


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, _BATCH_BYTES):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = prepared(text)
            found = [text[i:i + PIECE_CHARS] for i in range(0, len(text), PIECE_CHARS)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string())], names=["lang", "piece"])


def dictionaries(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(language, raw content) of the training rows ``docs``, the language with most rows first."""
    named = docs.filter("text is not null and lang is not null").select(text_or_empty("doc_id").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    counts = sorted(((r["count"], r["lang"]) for r in named.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    if not counts:
        return []
    share = F.create_map(*chain.from_iterable((F.lit(lang), F.lit(min(1.0, SAMPLE_TEXTS / n))) for n, lang in counts))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)
    pieces = named.filter(chosen).select("lang", "text").mapInArrow(_pieces, "lang string, piece string").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece")
    first = pieces.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= DICTIONARY_BYTES // PIECE_CHARS + 1)
    content: dict[str, list[str]] = {}
    for row in first.orderBy("lang", "place").collect():
        content.setdefault(row.lang, []).append(row.piece)
    return [(lang, "".join(content[lang]).encode()[:DICTIONARY_BYTES]) for _, lang in counts if lang in content]


class Compressors:
    """Sizes of a text under each dictionary."""

    def __init__(self, learned: list[tuple[str, bytes]]) -> None:
        self.langs = [lang for lang, _ in learned]
        self.encoders = [self._encoder(content) for _, content in learned]

    @staticmethod
    def _encoder(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=len(content), source_size=CHUNK_BYTES + len(LEAD), write_content_size=0, write_dict_id=0, write_checksum=0)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)

    def sizes(self, text: bytes) -> list[int]:
        parts = [LEAD + text[i:i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]
        return [sum(len(encoder.compress(part)) for part in parts) for encoder in self.encoders]

    def judge(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, margin, rejected."""
        text = prepared(text or "")
        if not text or not self.langs:
            return UNKNOWN, 0.0, None, True
        sizes = self.sizes(text.encode())
        best, *rest = sorted(sizes)
        score = 1 / sum(math.exp(max(-700.0, (best - s) / TEMPERATURE)) for s in sizes)
        margin = (rest[0] - best) / best if rest else 1.0
        return self.langs[sizes.index(best)], score, margin, margin < MARGIN


def predict(docs: DataFrame, learned: list[tuple[str, bytes]]) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``margin``, ``rejected`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Compressors(learned)
        for batch in chunks(batches, _BATCH_BYTES):
            found = [encoders.judge(text) for text in batch.column(2).to_pylist()]
            columns = list(zip(*found)) or [[]] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"])

    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(
        judged, f"doc_id {kind}, held_out boolean, lang_pred string, score double, margin double, rejected boolean")


def classify(docs: DataFrame) -> DataFrame:
    """``predict`` for every row, learned from the rows that are not held out."""
    return predict(docs, dictionaries(docs.filter(~held_out())))
