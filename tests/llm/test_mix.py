"""Operator 9 against plain Python: capped targets, seats by quotient, words taken from seeded blocks."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from punctual.llm import apportion

BLOCK, SHARD = 8, 5


def seeded(seed, *values):
    text = "-".join([str(seed), *("" if v is None else str(v) for v in values)])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def plain_targets(sizes):
    """Share by weight; whoever would get over three times its size stops there; share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = sum(sizes.values()) - sum(target.values())
        each = {s: Fraction(left * weight[s], sum(weight[x] for x in open_)) for s in open_}
        over = [s for s in open_ if each[s] >= 3 * sizes[s]]
        if not over:
            target.update(each)
            break
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            open_.remove(s)
    return target, order


def plain_seats(votes, number):
    """Highest quotients votes / (2k + 1), one seat after the other."""
    won = {k: 0 for k in votes}
    for _ in range(number if any(votes.values()) else 0):
        best = max((k for k in votes if votes[k] > 0), key=lambda k: (Fraction(votes[k]) / (2 * won[k] + 1), [-i for i, x in enumerate(votes) if x == k]))
        won[best] += 1
    return won


def plain_mix(rows, seed=apportion.SEED):
    """rows: (doc_id, text, source) with distinct ids."""
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sizes, counts = defaultdict(int), defaultdict(int)
    for _, n, s in sized:
        sizes[s] += n
        counts[s] += 1
    target, order = plain_targets(dict(sizes))
    seats = plain_seats({s: target[s] for s in order}, sum(sizes.values()) // BLOCK)
    out = {}
    for place, s in enumerate(order, 1):
        shards = defaultdict(list)
        for i, n, source in sized:
            if source == s:
                key = seeded(seed, i)
                shards[key % (counts[s] // SHARD + 1)].append((key, i, n))
        quotas = plain_seats({k: sum(r[2] for r in shards[k]) for k in sorted(shards)}, seats[s])
        for k, found in shards.items():
            blocks = max(1, -(-sum(r[2] for r in found) // BLOCK))
            quota = min(quotas[k], 3 * blocks)
            passes, extra, start = quota // blocks, quota % blocks, seeded(seed + 1, place, k) % blocks
            times = [passes + ((j + 1 + start) * extra // blocks - (j + start) * extra // blocks) for j in range(blocks)]
            at = 0
            for _, i, n in sorted(found):
                out[i] = (n, sizes[s], float(target[s]), sum(times[(at + x) // BLOCK] for x in range(n)))
                at += n
    return out


def told(df):
    return {r.doc_id: (r["size"], r.source_size, pytest.approx(r.target), r.taken) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_plain_version(spark, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "b", "hot", "ä", "zz"]
    rows = [(i, rng.choice([None, "", "w " * rng.randrange(40), "x\ty\n" * rng.randrange(20)]), "hot" if rng.random() < 0.4 else rng.choice(sources)) for i in range(90)]
    rows.append((1000, "big " * 400, "giant"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = told(apportion.mix(df, block_tokens=BLOCK, shard_rows=SHARD))
    want = plain_mix(rows)
    assert got.keys() == want.keys() and all(want[i] == got[i] for i in want)


def test_whole_copies_average_to_what_is_taken(spark):
    rows = [(i, "w " * 10, "a" if i % 10 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = apportion.mixed_documents(df)
    words = {r.source: r["count"] * 10 for r in mixed.groupBy("source").count().collect()}
    taken = {r.source: r.t for r in apportion.mix(df, carry=df.source).groupBy("row").sum("taken").toDF("source", "t").collect()}
    assert all(words[s] == pytest.approx(taken[s], rel=0.1) for s in taken) and taken["b"] == pytest.approx(9000, rel=0.02)
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 3
