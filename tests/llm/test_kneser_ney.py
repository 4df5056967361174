"""The n-gram model against a brute-force modified Kneser-Ney model."""

import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from punctual.llm import kneser_ney

START, END = "<start>", "<end>"


def brute(train, texts, order):
    """log10 of the probability of each text and its end."""
    grams = {k: Counter() for k in range(1, order + 1)}
    for t in train:
        w = [START, *t.split(), END]
        for k in range(2, order + 1):
            grams[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    level = {order: grams[order]}
    for k in range(order - 1, 0, -1):  # distinct words before; n-grams that start a text keep their counts
        before = Counter(g[1:] for g in grams[k + 1]) if k + 1 > 1 else Counter()
        level[k] = before + Counter({g: n for g, n in grams[k].items() if g[0] == START})
    words = {g[0] for g in level[1]}
    cut = {k: kneser_ney.discounts(Counter(c.values())) for k, c in level.items()}
    less = lambda k, n: cut[k][min(n, 3) - 1] if n else 0

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (len(words) + 1)
        rest = {g: n for g, n in level[k].items() if g[:-1] == gram[:-1]}
        if not rest:
            return p(gram[1:])
        n = rest.get(gram, 0)
        return (n - less(k, n) + sum(less(k, m) for m in rest.values()) * p(gram[1:])) / sum(rest.values())

    out = []
    for t in texts:
        w = [START, *t.split(), END]
        out.append(sum(math.log10(p(tuple(w[max(0, i - order + 1):i + 1]))) for i in range(1, len(w))))
    return out


@pytest.mark.parametrize("order,shard_tokens", [(3, 2_000_000), (3, 40), (2, 40)])
def test_scores_are_those_of_brute_force(spark, monkeypatch, order, shard_tokens):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice("a a a b b c d e f gg hh".split()) for _ in range(rnd.randint(0, 12))) for _ in range(60)]
    texts += ["a b c a b c a b c"] * 5 + ["new a b", "a b new c", "a new new b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    train = [t for i, t in enumerate(texts) if fold(i) != 1 and "new" not in t]
    model = kneser_ney.fit(spark.createDataFrame(list(enumerate(train)), "doc_id long, text string").repartition(3), shard_tokens=shard_tokens, order=order)
    got = {r.doc_id: r.score for r in kneser_ney.score(df, model).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(brute(train, texts, order), abs=1e-9)
    assert shard_tokens > 1000 or order < 3 or len(model.triple_shards) > 3


def test_third_word_tells_more(spark):
    """Pairs can't tell these apart: what follows b depends on the word before it."""
    texts = ["a b c"] * 20 + ["d b e"] * 20
    model = kneser_ney.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    ask = spark.createDataFrame([(0, "a b c"), (1, "a b e")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in kneser_ney.score(ask, model).collect()}
    assert score[0] > score[1] + 0.5


def test_tokens_hash_each_distinct_word_once(monkeypatch):
    random.seed(2)
    signs = " \t\n\x0b\x0c\r\x1c\x1f\x85 aAzZÄİéb.\x00"
    texts = [None, "", " ", "a", " a "] + ["".join(random.choice(signs) for _ in range(random.randrange(40))) for _ in range(500)]
    words = [(t or "").encode().lower().split() + [kneser_ney.END] for t in texts]
    hash_of, asked = kneser_ney.xxhash.xxh3_64_intdigest, []

    def counted(word):
        asked.append(word)
        return hash_of(word)

    monkeypatch.setattr(kneser_ney.xxhash, "xxh3_64_intdigest", counted)
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["x", *texts])[1:], pa.array([], pa.string())):
        asked.clear()
        h, place, starts = kneser_ney.tokens(column)
        mine = words[:len(column)]
        assert h[place].tolist() == [hash_of(w) >> 1 for ws in mine for w in ws]
        assert starts.tolist() == [sum(map(len, mine[:i])) for i in range(len(mine))]
        assert len(asked) == len(set(asked)) and set(asked) == {w for ws in mine for w in ws} | {kneser_ney.END}
