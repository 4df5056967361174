"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over the whole text in steps of two bytes. Their largest answers in each of the overlapping
chunks are combined by a hidden layer, whose units are max-pooled over all chunks of the text and combined into one
probability. Inputs are the bytes of the text, nothing else. The network is trained on the driver, from a sample of labelled
texts which is bounded by ``PER_CLASS`` texts of a label and ``SAMPLE_BYTES`` in all. Texts of the sample are whole, and
the number of steps is the same for every sample. Scoring is a narrow pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import binaries, chunks

WIDTH, FILTERS, HIDDEN = 6, 24, 16
#: Positions per chunk, and between the starts of chunks.
CHUNK, HOP = 128, 64
#: Bounds of the training sample: texts per label, and bytes of all its texts together. A text longer than one in ``SHARE`` of these bytes isn't sampled.
PER_CLASS, SAMPLE_BYTES, SHARE = 1500, 24 << 20, 32
STEPS, RATE, BATCH, SEED = 2250, 0.004, 16, 3
SEGMENT = 1 << 16
THRESHOLD = 0.3


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def start_network(seed: int = SEED) -> Network:
    r = np.random.default_rng(seed)
    f = np.float32
    return Network(
        (r.normal(size=(WIDTH, 256, FILTERS)) * 0.15).astype(f), np.zeros(FILTERS, f), (r.normal(size=(FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(f),
        np.zeros(HIDDEN, f), (r.normal(size=HIDDEN) / np.sqrt(HIDDEN)).astype(f), np.zeros(1, f))


def pair_codes(text: bytes) -> np.ndarray:
    """Bytes in twos as numbers; short texts are filled up to one filter width."""
    padded = text + b"\0" * max(len(text) % 2, WIDTH - len(text))
    return np.frombuffer(padded[:len(padded) // 2 * 2], ">u2")


def pair_tables(net: Network) -> list[np.ndarray]:
    """For each two bytes of the width: the answers of all filters to each of the 65536 pairs."""
    return [(net.table[k][:, None, :] + net.table[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]


def _answers(codes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    n = len(codes) - len(tables) + 1
    out = tables[0][codes[:n]]
    for k in range(1, len(tables)):
        out += tables[k][codes[k:n + k]]
    return out


def chunk_starts(n: int) -> np.ndarray:
    """Starts of overlapping chunks that cover all ``n`` positions; the last chunk ends at the end."""
    if n <= CHUNK:
        return np.zeros(1, np.int64)
    return np.unique(np.r_[np.arange(0, n - CHUNK + 1, HOP), n - CHUNK])


def chunk_maxima(codes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Largest answer of each filter in each chunk, a segment of the text at a time."""
    n = len(codes) - len(tables) + 1
    starts, out = chunk_starts(n), []
    for a in range(0, len(starts), SEGMENT // HOP):
        part = starts[a:a + SEGMENT // HOP]
        answers = _answers(codes[part[0]:part[-1] + CHUNK + len(tables) - 1], tables)
        local = part - part[0]
        if len(part) == 1:
            out.append(answers.max(0)[None])
            continue
        blocks = len(answers) // HOP
        block = answers[:blocks * HOP].reshape(blocks, HOP, FILTERS).max(1)
        even = local[local % HOP == 0] // HOP
        out.append(np.maximum(block[even], block[even + 1]))
        if local[-1] % HOP:
            out.append(answers[local[-1]:].max(0)[None])
    return np.concatenate(out)


def probability(text: bytes, net: Network, tables: list[np.ndarray]) -> float:
    maxima = np.maximum(chunk_maxima(pair_codes(text), tables) + net.bias, 0)
    pooled = np.maximum(maxima @ net.hidden + net.hidden_bias, 0).max(0)
    return float(1 / (1 + np.exp(-np.clip(pooled @ net.out + net.out_bias[0], -30, 30))))


def train(texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = SEED) -> Network:
    """Adam on the log loss, both labels with equal weight. Gradients flow through the two maxima only, so they touch few rows of the filters.

    The texts are gone through in new orders, one after the other, until the steps are done.
    """
    net, r = start_network(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    raw = [pair_codes(t).view(np.uint8) for t in texts]
    weight = [len(labels) / (2 * max(1, labels.count(k))) for k in (0, 1)]
    ahead: list[int] = []
    for step in range(1, steps + 1):
        rate = RATE * (1 - (step - 1) / steps)
        while len(ahead) < BATCH:
            ahead.extend(r.permutation(len(texts)))
        batch, ahead = ahead[:BATCH], ahead[BATCH:]
        grads = [np.zeros_like(p) for p in net.params()]
        for i in batch:
            _backward(raw[i], labels[i], net, grads, weight[labels[i]] / BATCH)
        for p, g, (m, v) in zip(net.params(), grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
    return net


def _backward(raw: np.ndarray, label: int, net: Network, grads: list[np.ndarray], weight: float) -> None:
    n = len(raw) // 2 - WIDTH // 2 + 1
    answers = net.table[0][raw[0:2 * n:2]]
    for k in range(1, WIDTH):
        answers = answers + net.table[k][raw[k:2 * n + k:2]]
    starts = chunk_starts(n)
    where = np.stack([s + answers[s:s + CHUNK].argmax(0) for s in starts])  # chunk x filter
    top = np.take_along_axis(answers, where, 0) + net.bias
    maxima = np.maximum(top, 0)
    units = maxima @ net.hidden + net.hidden_bias
    best = units.argmax(0)
    pooled = np.maximum(units[best, np.arange(HIDDEN)], 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.out_bias[0], -30, 30)))
    d = np.float32((p - label) * weight)
    grads[5][0] += d
    grads[4] += d * pooled
    d_units = np.where(pooled > 0, d * net.out, 0)
    np.add.at(grads[3], np.arange(HIDDEN), d_units)
    grads[2] += (maxima[best] * d_units[:, None]).T
    d_max = np.zeros_like(maxima)
    np.add.at(d_max, best, d_units[:, None] * net.hidden.T)
    d_max *= top > 0
    used, filters = np.nonzero(d_max)
    values, at = d_max[used, filters], where[used, filters]
    np.add.at(grads[1], filters, values)
    for k in range(WIDTH):
        np.add.at(grads[0][k], (raw[2 * at + k], filters), values)


def sample(df: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """Whole labelled texts, smallest hashes of the id first: at most ``per_class`` of each label and ``most`` bytes in all. df: doc_id, text; labels: doc_id, label."""
    chosen = None
    for label in (0, 1):
        some = labels.filter(F.col("label") == label).select("doc_id", "label").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    size = F.octet_length(F.coalesce("text", F.lit("")))
    texts = df.join(F.broadcast(chosen), "doc_id").withColumn("size", size).filter(F.col("size") <= most // SHARE) \
        .withColumn("print", F.xxhash64("text"))  # 2 * per_class short rows are broadcast
    short = texts.select("doc_id", "label", "print", "size").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "print").limit(2 * per_class)
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "print", "label"))
    taken = short.withColumn("so_far", so_far).filter(F.col("so_far") <= most).select("doc_id", "label", "print")
    rows = texts.join(F.broadcast(taken), ["doc_id", "label", "print"], "left_semi") \
        .groupBy("doc_id", "label", "print").agg(F.min("text").alias("text")).collect()  # bounded by ``most``
    ordered = sorted(((r.doc_id, r.print, r.label, (r.text or "").encode()) for r in rows), key=lambda r: (r[1], str(r[0]), r[2]))
    return [r[3] for r in ordered], [r[2] for r in ordered]


def classify(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", folds: int = 5, held: int = 0,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Learns from labelled rows outside the held-out fold (CRC-32 of the id as text); labels other than 0 and 1 are
    left out. Without both labels there, every score is 0.5. Null and empty texts are scored as such. A null id is an empty text for
    the fold and is never learned from. Repeated rows get equal scores.
    """
    fold = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds
    given = df.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{label_column}`").cast("int").alias("label")) \
        .filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != held))
    texts, marks = sample(given, known)
    net = train(texts, marks) if len(set(marks)) == 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pair_tables(net) if net is not None else None
        for chunk in chunks(batches, 8 << 20):
            scores = [probability(t, net, tables) if net is not None else 0.5 for t in binaries(chunk.column(1))]
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = df.schema[id_column].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", (fold(F.col("doc_id")) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
