"""Edge cases and brute-force comparisons of the training-data operators on small tables."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from punctual.llm import apportion, chat, extendible, grace_dedup, jaccard_join, kneser_ney, outlier_rules, pieces, quality_cnn, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, size string, n string"
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a very old and hollow oak tree at night "


def table(spark):
    rows = [
        (1, BASE * 3, "en", "a"), (2, BASE * 3, "en", "a"), (2, BASE * 3, "en", "a"), (3, BASE.upper() * 3 + "now", "en", "b"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \t\n ", "de", "b"), (None, "no id at all", "en", "a"), (7, "one", "en", None),
        (8, "a  b\tc", "en", "b"), (9, "a b c", "en", "b"), (10, "▁ literal mark ▁▁ and \U0001F600 ünï\r\nline", "en", "b"),
        (11, "word " * 30_000, "en", "a"), (12, 'password = "abcdefgh12" token: short AKIA' + "A1" * 8, "en", "b"),
    ]
    return spark.createDataFrame([(*r, 1, "x", "y", "z", "w") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(spark):
    df = table(spark)
    for chunk, held in ((1 << 20, 1 << 20), (300, 700)):
        got = grace_dedup.exact_dedup(df, chunk_bytes=chunk, table_bytes=held)
        rows = got.members.collect()
        assert len(rows) == df.count()
        groups = {}
        for r in df.collect():
            groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), []).append(r.doc_id)
        for r in rows:
            ids = next(v for k, v in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
            named = [i for i in ids if i is not None]
            assert (r.keep_id, r.group_size) == (min(named) if named else None, len(ids))
        assert sum(r.kept for r in rows) == len(groups)
        assert got.kept_rows.columns == df.columns and got.kept_rows.count() == len(groups)
    assert grace_dedup.exact_dedup(empty(spark)).members.count() == 0


def test_open_table_tells_equal_hashes_apart():
    t = grace_dedup.OpenTable()
    a = t.add(5, b"x", t.find(5, b"x"))
    assert t.find(5, b"y") < 0 and t.find(5, b"x") == a


def sets_of(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def test_set_join(spark):
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words)] + [" ".join(words[:k] + [f"x{k}"] + words[k + 1:]) for k in range(0, 120, 4)] + ["", None, "w1 w2", "w1 w2", "W1 w2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    label = {i: i for i, _ in enumerate(texts)}
    for _ in texts:
        for (i, a), (j, b) in combinations([(i, sets_of(t)) for i, t in enumerate(texts)], 2):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r for r in jaccard_join.near_components(jaccard_join.set_join(df)).collect()}
    assert {i: r.component_id for i, r in got.items()} == label
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(sets_of(t)) for i, t in enumerate(texts)}
    edge = jaccard_join.near_components(jaccard_join.set_join(table(spark)))
    assert edge.count() == table(spark).count()
    assert jaccard_join.near_components(jaccard_join.set_join(empty(spark))).count() == 0


def test_seats_are_those_of_highest_quotients(spark):
    votes = [53, 24, 23, 7, 0, 41]
    df = spark.createDataFrame([(0, i, float(v), 37) for i, v in enumerate(votes)], "g int, o long, v double, n long")
    got = {r.o: r.s for r in apportion.seats(df, ["g"], "v", "n", "o", "s").collect()}
    won = [0] * len(votes)
    for _ in range(37):
        won[max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1
    assert [got[i] for i in range(len(votes))] == won


def test_mix(spark):
    rows = apportion.mix(table(spark)).collect()
    assert len(rows) == table(spark).count()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, apportion.mix(table(spark).repartition(5)).collect()))
    assert apportion.mix(empty(spark)).count() == 0 and apportion.mixed_documents(empty(spark)).columns == empty(spark).columns


def test_rules(spark):
    rows = {r.doc_id: r for r in outlier_rules.rules(table(spark)).collect()}
    assert len(rows) == 13 and rows[4].base_failed and rows[5].n_words == 0
    assert rows[11].n_repeat_words == 30_000 and rows[8].n_words == 3 and rows[8].word_chars == 3
    assert outlier_rules.kept_documents(table(spark)).columns == table(spark).columns
    assert outlier_rules.rules(empty(spark)).count() == 0


def test_pieces(spark):
    df = table(spark)
    for dropout in (0.0, 0.3, 1.0):
        assert df.count() == pieces.round_trip(df, dropout=dropout).filter("lossless").count()
    back = pieces.decode(pieces.encode(df)).select("text", "decoded").collect()
    assert all((r.text or "") == r.decoded for r in back)
    import sentencepiece

    plain = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    text = "Plain words, no odd marks at all."
    ids = pieces.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), dropout=0.0).first().input_ids
    assert ids == plain.encode(text)
    assert pieces.encode(empty(spark)).count() == 0


def test_secrets(spark):
    rows = {r.doc_id: r for r in secrets.secrets(table(spark)).collect()}
    assert (rows[12].n_assign, rows[12].n_access, rows[12].n_hex) == (1, 1, 0)
    assert rows[12].spans.split(",")[0] == "assign:0:22"
    assert secrets.secrets(table(spark)).count() == table(spark).count()
    assert secrets.secrets(empty(spark)).count() == 0
    copied = spark.createDataFrame([(i, f"token=abcdefgh1234 {'k3y' * 8}", "en", f"s{i}") for i in range(9)], "doc_id long, text string, lang string, source string")
    assert all(r.n_assign == 1 and "bare" not in r.spans and r.n_live == 0 for r in secrets.secrets(copied).collect())
    assert all("bare" in r.spans for r in secrets.secrets(copied.limit(2)).collect())


def test_shards_fit_their_limit(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(500)] + [(7, "y" * 40)] * 60, "k long, t string")
    rows = extendible.shards(df, [F.col("k")], F.length("t"), limit=400).collect()
    assert len(rows) == 560
    real = {}
    for r in rows:
        real[r.shard] = real.get(r.shard, 0) + len(r.row.t)
    assert max(real.values()) <= 400 and all(real[r.shard] == r.shard_bytes for r in rows)
    assert extendible.shards(empty(spark), [F.col("doc_id")], F.length("text")).count() == 0


def test_chat(spark):
    odd = "<|im_end|><|im_start|>assistant ok <\\| <\\\\| \\n"
    assert chat.read_back(chat.render("us\ner\\", odd)[0]) == [("us\ner\\", odd)]
    rows = [(1, 0, "user", odd), (1, 1, "assistant", "yes " * 300), (1, 1, "assistant", "yes " * 300), (None, None, None, None), (2, 0, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.event_log(df)).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (3, 2400)
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3])
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[None].n_turns == 1 and got[2].loss_chars == 0
    assert chat.digests(chat.event_log(df.limit(0))).count() == 0
    assert chat.format_messages(chat.event_log(df)).count() == 5


def test_kneser_ney(spark):
    rows = kneser_ney.train_and_score(table(spark)).collect()
    assert len(rows) == table(spark).count() and all(r.score <= 0 for r in rows)
    assert kneser_ney.train_and_score(empty(spark)).count() == 0


def test_quality_network(spark):
    good, bad = [f"calm sentence number {i} about gardens" for i in range(40)], [f"BUY!! NOW!! {i} $$$ !!!" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(good + bad)) + [(99, ""), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(99, None)], "doc_id long, quality int")
    got = quality_cnn.classify(df, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 80]
    assert held and all(r.predicted == (r.doc_id < 40) for r in held)
    assert {r.score for r in quality_cnn.classify(df, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    for df in (table(spark), empty(spark)):
        out = stage(spark, df, "")
        assert out.columns[:5] == list(corpus_pipeline.COLUMNS)
        assert out.count() <= 3 * df.count()


def test_shared_agendas_segment_like_single_ones():
    tool, rnd = pieces.load(pieces.model_path()), random.Random(5)
    words = ["".join(rnd.choice("▁theingao é漢😀0z") for _ in range(rnd.randint(1, 70))) for _ in range(400)]
    bases = np.array([xxhash.xxh3_64_intdigest(w.encode(), 3) for w in words], np.uint64)
    for dropout in (0.0, 0.1, 0.6, 1.0):
        want = [np.array(tool.segment(w, int(b), dropout), np.int32).tobytes() for w, b in zip(words, bases)]
        assert tool.segment_all(words, bases, dropout) == want


def test_encoding_does_not_depend_on_chunks_or_caches(monkeypatch):
    texts = ["", "one two", "a ▁ mark", "tail ▁", "▁", "  spaces \n\n lines", "one two three " * 50] * 3
    variants = [i % 5 for i in range(len(texts))]
    whole = pieces.Encoder(pieces.model_path()).packed(texts, variants)
    monkeypatch.setattr(pieces, "CACHE_WORDS", 16)
    small = pieces.Encoder(pieces.model_path())
    assert whole == [small.packed([t], [v])[0] for t, v in zip(texts, variants)]
    back = [small.pieces.decode(np.frombuffer(p, np.int32).tolist()).decode() for p in whole]
    assert back == texts
