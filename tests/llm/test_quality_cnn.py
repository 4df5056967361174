"""The byte network against plain convolution, and the bounds of its sample."""

import numpy as np
import pytest

from punctual.llm import quality_cnn as q


def naive(text, net):
    """The same network with loops over positions, chunks and filters."""
    padded = text + b"\0" * max(len(text) % 2, q.WIDTH - len(text))
    padded = padded[:len(padded) // 2 * 2]
    answers = np.array([sum(net.table[k, padded[a + k]].astype(float) for k in range(q.WIDTH)) for a in range(0, len(padded) - q.WIDTH + 1, 2)])
    last = max(0, len(answers) - q.CHUNK)
    starts = sorted({*range(0, last + 1, q.HOP), last})
    units = [np.maximum(np.maximum(answers[s:s + q.CHUNK].max(0) + net.bias, 0) @ net.hidden + net.hidden_bias, 0) for s in starts]
    return 1 / (1 + np.exp(-(np.max(units, 0) @ net.out + net.out_bias[0])))


@pytest.mark.parametrize("segment", [q.SEGMENT, 3 * q.HOP])
def test_scores_are_those_of_a_plain_convolution(monkeypatch, segment):
    monkeypatch.setattr(q, "SEGMENT", segment)
    r = np.random.default_rng(1)
    net = q.train([b"good text " * 5, b"xx## " * 9], [1, 0], steps=4)
    net.bias += r.normal(size=q.FILTERS).astype(np.float32) * 0.1
    tables = q.pair_tables(net)
    for n in (0, 1, 5, 6, 7, 255, 256, 260, 261, 262, 263, 390, 1024, 1500, 5001):
        text = bytes(r.integers(0, 256, n, dtype=np.uint8))
        assert q.probability(text, net, tables) == pytest.approx(naive(text, net), abs=1e-5)


def test_every_part_of_a_text_counts():
    """What tells the labels apart stands at one place of a long text, in training and afterwards."""
    r = np.random.default_rng(2)
    noise = [bytes(r.integers(97, 123, 12_000, dtype=np.uint8)) for _ in range(24)]
    at = r.integers(100, 11_800, 24)
    marked = [t[:a] + b"#$#$#$#$#$#$#$#$" + t[a:] if i % 2 else t for i, (t, a) in enumerate(zip(noise, at))]
    net = q.train(marked[:16], [i % 2 for i in range(16)], steps=200)
    scores = [q.probability(t, net, q.pair_tables(net)) for t in marked[16:]]
    assert min(scores[1::2]) > max(scores[::2])


def test_sample_is_bounded_and_whole(spark):
    texts = {i: ("ab" * 40 if i % 2 else "c" * 50) + str(i) for i in range(60)} | {60: "long " * 4000, 61: None}
    rows = [*texts.items(), (3, texts[3])]  # a row twice is one text
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, label int")
    whole = {(t or "").encode() for i, t in texts.items() if i != 60}
    got, marks = q.sample(df, labels, most=32 * 1000)
    assert sorted(got) == sorted(whole) and sum(marks) == 31
    some, _ = q.sample(df, labels, most=3200)
    assert set(some) <= whole and 2500 < sum(map(len, some)) <= 3200
    few, marks = q.sample(df, labels, per_class=4, most=32 * 1000)
    assert sum(marks) == 4 and len(few) in (7, 8)  # the long text may be among the four
    assert q.sample(df.repartition(2), labels, most=3200)[0] == some
