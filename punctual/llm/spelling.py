"""Spelling variants by permuterm rotations.

Every word is closed with a terminator that no word holds, and all its rotations are laid out in order. Two words that differ
by a replaced code point have rotations which agree in all but the last code point, and an inserted or deleted code point
makes a rotation of the shorter word the beginning of one of the longer word. So every rotation is filed under its beginning
without the edited code point, and words whose rotations stand in the same file are near. A file holds one word for each code
point at the edited place, and one word without any: at most the alphabet and one, whatever the corpus holds.

Rows: a null text has no words, a null ``doc_id`` counts as empty, an empty table gives an empty result, repeated rows count
as often as they stand, other columns are not read. Texts are counted in spans of ``SPAN_BYTES`` that end between words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import binaries, chunks, text_or_empty
from punctual.staging import scratch_tables, stage

# Fixed values of the contract: runs of a-z and U+00C0 to U+00FF as UTF-8, the changed occurrences, the least words and ratio.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
BETWEEN = re.compile(rb"[^a-z\x80-\xbf\xc3]")
CHANGED = 199
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5

TERMINATOR = "$"
SPAN_BYTES = 4 << 20
CHUNK_BYTES = 16 << 20
COUNTER_WORDS = 300_000


def _spans(text: bytes) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(text):
        found = BETWEEN.search(text, start + SPAN_BYTES)
        end = found.start() if found else len(text)
        yield start, end
        start = end


def _result(run: bytes, h: int) -> bytes:
    if h % CHANGED:
        return run
    word = run.decode()
    place = h % len(word)
    return (word[:place] + word[place + 1:]).encode()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n); a word comes once for each time that the counter was full."""
    total: Counter[bytes] = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        total.clear()
        return out

    for batch in chunks(batches, CHUNK_BYTES):
        for doc_id, text in zip(binaries(batch.column(0)), binaries(batch.column(1))):
            before, text = zlib.crc32(doc_id + b":"), text.lower()
            for start, end in _spans(text):
                for run, n in Counter(RUN.findall(text, start, end)).items():
                    word = _result(run, zlib.crc32(run, before))
                    if len(word) - word.count(b"\xc3") >= LEAST_CHARS:
                        total[word] += n
                if len(total) >= COUNTER_WORDS:
                    yield told()
    yield told()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: the words of at least six code points that occur five times or more in the whole table."""
    found = docs.select(text_or_empty("doc_id"), text_or_empty("text")).mapInArrow(_counts, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """``key``, ``edited``, ``opens``, ``n``: rotations by their beginning; ``edited`` is empty where the whole rotation is the key.

    ``opens`` is false at a code point equal to the one before it: deleting either gives the same word, and one of them is enough.
    """
    size = F.length("word")
    at = F.col("at")
    whole = at < 0  # -1 - place for the whole rotation, place for the one that leaves out the code point there
    place = F.when(whole, -1 - at).otherwise(at)
    cut = F.col("cut")
    placed = words.select("word", "n", F.explode(F.sequence(-1 - size, size - 1)).alias("at")).select(
        "word", "n", place.alias("cut"), F.when(whole, "").otherwise(F.substring("word", at + 1, F.lit(1))).alias("edited"), whole.alias("whole"))
    return placed.select(
        F.concat(
            F.substring("word", cut + F.when(F.col("whole"), 1).otherwise(2), F.length("word")), F.lit(TERMINATOR),
            F.substring("word", F.lit(1), cut)).alias("key"),
        "edited",
        (F.col("whole") | (cut == 0) | (F.substring("word", cut, F.lit(1)) != F.col("edited"))).alias("opens"),
        "n",
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``best``: the number of near words, and (-n, word) of the first of them by falling n, or null."""
    filed = (
        rotations(words).groupBy("key").agg(F.collect_list(F.struct("n", "edited", "opens")).alias("file")).filter(F.size("file") > 1)
        .withColumn("after", F.substring_index("key", TERMINATOR, 1)).withColumn("before", F.substring_index("key", TERMINATOR, -1))
    )

    def word(member):
        return F.concat("before", member.edited, "after")

    def told(member):
        near = F.filter("file", lambda x: (x.edited != member.edited) & (((x.edited != "") & (member.edited != "")) | (x.opens & member.opens)))
        return F.struct(
            word(member).alias("word"), member.n.alias("n"), F.size(near).cast("long").alias("n_near"),
            F.array_min(F.transform(near, lambda x: F.struct((-x.n).alias("minus_n"), word(x).alias("word")))).alias("best"))

    found = filed.select(F.explode(F.transform("file", told)).alias("m")).select("m.*").filter("n_near > 0")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    return found.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """``word``, ``root`` for words with a form. Counts grow fivefold with every form, so a path has few steps; each round doubles the length followed."""
    links = stage(links, "spelling-links")
    roots = links.select("word", F.col("form").alias("root"))
    while roots.join(links.select(F.col("word").alias("root")), "root", "left_semi").limit(1).count():
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stage(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return roots


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``word_counts``."""
    with scratch_tables(docs.sparkSession):
        words = stage(word_counts(docs), "spelling-words")
        better = -F.col("best.minus_n") >= RATIO * F.col("n")
        formed = stage(neighbours(words).select(
            "word", F.when(better, F.col("best.word")).alias("form"), "n", "n_near", F.when(better, -F.col("best.minus_n")).alias("form_n")), "spelling-forms")
        roots = _roots(formed.filter("form is not null").select("word", "form"))
        out = formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return stage(out, "spelling-variants", outlives=True)
