"""Operator 12: held-out accuracy, the rows it learns from, odd rows."""

import zlib

import pytest
from pyspark.sql import functions as F

from punctual.llm import language
from punctual.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op12_compression_language"](spark, sf_dir).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    kept = [r for r in held if not r.rejected]
    assert len(kept) >= 0.95 * len(held) and sum(r.lang_pred == truth[r.doc_id] for r in kept) >= 0.99 * len(kept)
    assert all(0 <= r.score <= 1 for r in rows)


EN, DE = "the cat sat on the mat and the dog barked at it ", "der Hund und die Katze sind nicht mehr im Haus "


def _docs(spark, n=40):
    rows = [(i, EN * 3 if i % 2 else DE * 3, "en" if i % 2 else "de", "s") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_learns_from_the_other_rows_only(spark):
    docs = _docs(spark)
    wrong = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(language.classify(wrong).collect()) == sorted(language.classify(docs).collect())
    assert {r.lang_pred for r in language.classify(docs.withColumn("source", F.lit("t"))).collect()} == {"en", "de"}


def test_odd_rows(spark):
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 34 ² !?", "de"), (None, EN, "de"), (103, "the dog", None), (1, EN, "en"), (1, EN, "en"),
           (104, (EN * 4000) + DE, None), (105, "x", ""), (106, "ÐЖ", None)]
    docs = _docs(spark).drop("source").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    for name in ("lang_pred", "score", "held_out", "piece", "place"):
        docs = docs.withColumn(name, F.lit("no"))
    rows = language.classify(docs).collect()
    assert len(rows) == 50
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by_id[100].score == 0
    assert by_id[104].lang_pred == "en" and by_id[103].lang_pred == "en" and by_id[None].held_out is False
    assert by_id[106].lang_pred in {"en", "de", ""} and by_id[106].rejected


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.classify(empty).collect() == []
    unnamed = spark.createDataFrame([(1, EN, None), (2, DE, None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.classify(unnamed).collect()} == {("und", 0.0)}


def test_sizes_cover_the_whole_text():
    judge = language.Compressors([("a", EN.encode()), ("b", DE.encode())])
    long = (EN * 2000).encode()
    assert all(x > y for x, y in zip(judge.sizes(long + (DE * 500).encode()), judge.sizes(long)))


@pytest.mark.parametrize("text, want", [("A  a a-B_b 12c", "a b c "), ("12 ?!", ""), ("²", "")])
def test_prepared(text, want):
    assert language.prepared(text) == want
