"""Co-occurrence vectors against plain counts, a dense decomposition and word vectors trained by the library."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from punctual.operators import cluster, embedding


@pytest.fixture(scope="module")
def lists():
    """Rows of 10 tokens; tokens of a group come together."""
    rng = random.Random(3)
    rows = []
    for _ in range(700):
        g = rng.randrange(4)
        rows.append([f"g{g}_{rng.randrange(6)}" if rng.random() < 0.85 else f"g{rng.randrange(4)}_{rng.randrange(6)}" for _ in range(10)])
    return rows + [rows[0]] * 50 + [["once", "g0_1"], ["alone"], []]


@pytest.fixture(scope="module")
def frame(spark, lists):
    return spark.createDataFrame([(t,) for t in lists], "tokens array<string>").repartition(4).cache()


def plain(lists, window=7, least=5):
    known = {w for w, n in Counter(w for t in lists for w in t).items() if n >= least}
    return Counter((a, b) for t in lists for i, a in enumerate(t) for j, b in enumerate(t) if i != j and abs(i - j) <= window and a in known and b in known)


def vectors(model):
    return {r["word"]: np.array(r["vector"]) for r in model.vectors.collect()}


def test_counts(frame, lists):
    got = {(r["word"], r["context"]): r["n"] for r in embedding.cooccurrences(frame).collect()}
    assert got == dict(plain(lists))


def test_lists_are_read_once_and_counted_in_parts(spark, frame, lists, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    more = [[None, "x", None, "x"], None, [None]]
    df = frame.union(spark.createDataFrame([(t,) for t in more] * 5, "tokens array<string>")).mapInArrow(told, "tokens array<string>")
    want = dict(plain([t for t in lists + more * 5 if t]))
    want = {pair: n for pair, n in want.items() if None not in pair}
    assert {(r["word"], r["context"]): r["n"] for r in embedding.cooccurrences(df).collect()} == want
    assert read.value == len(lists) + 15
    monkeypatch.setattr(embedding, "HELD_PAIRS", 50)
    monkeypatch.setattr(embedding, "SENT_PAIRS", 7)
    rows = pa.array([*lists, *more * 5], pa.list_(pa.string()))
    batches = [pa.RecordBatch.from_arrays([rows.slice(i, 40)], names=["t"]) for i in range(0, len(rows), 40)]
    found = Counter()
    for batch in embedding._counted(7)(iter(batches)):
        assert batch.num_rows <= 7
        for r in batch.to_pylist():
            found[r["word"], r["context"]] += r["n"]
    both = Counter()
    for (a, b), n in found.items():
        if b is not None:
            both[a, b] += n
            both[b, a] += n
    assert {k: n for k, n in both.items() if min(found[w, None] for w in k) >= 5} == want


def test_vectors_are_the_leading_eigenvectors(frame, lists):
    counts = plain(lists)
    words = sorted({a for a, _ in counts})
    m = np.zeros((len(words), len(words)))
    for (a, b), n in counts.items():
        m[words.index(a), words.index(b)] = n
    total = m.sum(axis=1)
    with np.errstate(divide="ignore"):
        m = np.maximum(np.log(m * m.sum() / np.outer(total, total)), 0)
    values, u = np.linalg.eigh(m)
    got = vectors(embedding.fit(frame, vectorSize=3))
    ours = np.array([got[w] for w in words])
    want = (u * np.sqrt(np.maximum(values, 0)))[:, ::-1][:, :3]
    assert ours @ ours.T == pytest.approx(want @ want.T, abs=1e-3)


def test_layout_does_not_matter(frame):
    a, b = (vectors(embedding.fit(frame.repartition(n), vectorSize=4)) for n in (1, 7))
    assert a.keys() == b.keys() and all(a[w] == pytest.approx(b[w], abs=1e-6) for w in a)


def test_neighbours_agree_with_word2vec(frame):
    ours = vectors(embedding.fit(frame, vectorSize=4))
    theirs = {r["word"]: r["vector"].toArray() for r in cluster.fit_word2vec(frame, partitions=1, vectorSize=8, maxIter=8).getVectors().collect()}

    def groups(found):
        words = sorted(w for w in found if w.startswith("g"))
        x = np.array([found[w] / np.linalg.norm(found[w]) for w in words])
        near = x @ x.T - 2 * np.eye(len(words))
        return np.mean([words[i][:2] == words[j][:2] for i in range(len(words)) for j in near[i].argsort()[-5:]])

    assert groups(ours) > 0.95 and groups(theirs) > 0.8


def test_lists_have_the_mean_of_their_tokens(spark, frame):
    model = embedding.fit(frame, vectorSize=4)
    found = vectors(model)
    odd = spark.createDataFrame([(1, ["g0_1", "nowhere"]), (2, []), (3, None), (4, ["nowhere"]), (5, ["g0_1", "g2_2", "g2_2"])], "id int, tokens array<string>")
    want = {1: found["g0_1"] / 2, 2: 0 * found["g0_1"], 3: 0 * found["g0_1"], 4: 0 * found["g0_1"], 5: (found["g0_1"] + 2 * found["g2_2"]) / 3}
    for limit in (embedding.BROADCAST_BYTES, 0):
        model.broadcast_bytes = limit
        got = {r["id"]: r["v"] for r in model.transform(odd).select("id", vector_to_array("category_vec").alias("v")).collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_few_words_and_none(spark, frame):
    two = frame.limit(0).union(spark.createDataFrame([(["a", "b"],)] * 9 + [(["a", "c"],)] * 9, "tokens array<string>"))
    got = vectors(embedding.fit(two))
    assert set(got) == {"a", "b", "c"} and all(len(v) == 20 for v in got.values()) and got["b"] == pytest.approx(got["c"], abs=1e-6)
    assert vectors(embedding.fit(frame.limit(0))) == {}
    flat = spark.createDataFrame([(["a", "a"],)] * 9, "tokens array<string>")
    assert vectors(embedding.fit(flat))["a"] == pytest.approx(np.zeros(20))
    assert embedding.fit(flat).transform(flat).filter(F.col("category_vec").isNull()).count() == 0
