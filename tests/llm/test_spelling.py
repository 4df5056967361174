"""Operator 13 against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctual.llm import spelling
from punctual.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            place = h % len(run)
            counts[run[:place] + run[place + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = counted(rows)
    forms, told = {}, {}
    for w, n in counts.items():
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x.encode()), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * n else None
        told[w] = len(close)

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted((w, forms[w] or "", root(w), counts[w], told[w], counts[forms[w]] if forms[w] else -1) for w in counts)


def got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


CHAIN = [
    (1, "harbour " * 700), (2, "harbor " * 30), (3, "Harbors " * 5 + "HARBOUR"), (4, "harbours " * 120), (5, "aaaaaa " * 40 + "aaaaaaa " * 300 + "aaaaaab " * 6),
    (6, "élèves× " * 9 + "Élèves× " * 60 + "élèves " * 5), (7, None), (8, ""), (None, "harbaur " * 5), (4, "harbours " * 9),
    (10, "bbcdef,bacdef;" * 25 + "aacdef-" * 5 + "abcdef " * 5), (11, "x" * 300 + " " + "short " * 50),
]


def test_chains_ties_repeats_and_odd_rows(spark):
    docs = spark.createDataFrame(CHAIN, "doc_id long, text string")
    assert got(spelling.variants(docs)) == brute(CHAIN)
    found = {r.word: r for r in spelling.variants(docs).collect()}
    assert found["harbors"].root == "harbour" and found["aaaaaaa"].n_near == 2


def test_spans_end_between_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SPAN_BYTES", 7)
    monkeypatch.setattr(spelling, "COUNTER_WORDS", 2)
    text = CHAIN[5][1].encode().lower()
    parts = [text[a:b] for a, b in spelling._spans(text)]
    assert b"".join(parts) == text
    assert Counter(w for p in parts for w in spelling.RUN.findall(p)) == Counter(spelling.RUN.findall(text))


def test_query_on_a_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = counted(rows)
    got_rows = QUERIES["op13_permuterm_variants"](spark, sf_dir).collect()
    assert {r.word: r.n for r in got_rows} == want
    some = sorted(want, key=lambda w: zlib.crc32(w.encode()))[:150]
    by_word = {r.word: r for r in got_rows}
    for w in some:
        close = [x for x in want if near(w, x)]
        assert by_word[w].n_near == len(close)
        best = min(close, key=lambda x: (-want[x], x.encode()), default=None)
        assert by_word[w].form == (best if best is not None and want[best] >= 5 * want[w] else None)


@pytest.mark.parametrize("columns", ["doc_id long, text string", "doc_id long, text string, word string, n long, key string, file string, form string"])
def test_empty_table_and_clashing_columns(spark, columns):
    empty = spark.createDataFrame([], columns)
    assert spelling.variants(empty).collect() == []
    if "key" in columns:
        docs = spark.createDataFrame(CHAIN, "doc_id long, text string")
        for name in ("word", "n", "key", "file", "form"):
            docs = docs.withColumn(name, F.lit("no"))
        assert got(spelling.variants(docs)) == brute(CHAIN)
