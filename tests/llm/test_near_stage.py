"""The near-duplicate stage of the pipeline against brute force."""

import random
from itertools import combinations

import pyarrow as pa

import corpus_pipeline
from punctual.llm import jaccard_join


def shingles(text, words=5):
    w = (text or "").lower().split()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}


def test_near_stage_takes_five_words_and_eighty_percent(spark):
    words = [f"w{i}" for i in range(400)]
    changed = lambda n, mark: " ".join(f"{mark}{i}" if i % (400 // n) == 20 else w for i, w in enumerate(words))
    # 2 % of the words changed link (356 of 436 shingles, but 374 of 422 of three words), 3 % don't, nor with each other.
    texts = [" ".join(words), changed(8, "x"), changed(8, "y"), changed(12, "z"), changed(4, "q"), "a b c d e", "a b c d e f", "a b c", "A b c", "", None]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    label = dict(enumerate(range(len(texts))))
    sets = [shingles(t) for t in texts]
    for _ in texts:
        for i, j in combinations(range(len(texts)), 2):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[i] = label[j] = min(label[i], label[j])
    assert label[1] == 0 and label[3] == 3
    near = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert sorted(r.doc_id for r in near(spark, df, "").collect()) == sorted(set(label.values()))


def test_unlinked_relatives_are_told_by_few_of_their_lists(spark, monkeypatch):
    # Sixty texts off one text, each with about one word in 80 changed: few link, but all share listed shingles.
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(f"{n}x{i}" if random.random() < 0.013 else w for i, w in enumerate(words)) for n in range(60)]
    sets = [shingles(t) for t in texts]
    linked = {(i, j) for i, j in combinations(range(60), 2) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    label = list(range(60))
    for _ in texts:
        for i, j in linked:
            label[i] = label[j] = min(label[i], label[j])
    seen = []
    rows_of = jaccard_join._Join._listed_pairs

    def listed(*args):
        out = rows_of(*args)
        seen.append((out.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(jaccard_join._Join, "_listed_pairs", listed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard_join.near_components(jaccard_join.set_join(df, words=5, percent=80))
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(label))
    assert 1 < len(set(label)) < 60
    (rows, pairs), = seen
    # Lists of sixty sets hold 1770 pairs each; most are ruled out, and a pair comes from few of its lists.
    assert rows <= 16 * pairs and pairs < 400


def test_lists_keep_only_entries_with_a_partner():
    random.seed(5)
    rows = []
    for token in range(60):
        for _ in range(random.choice([1, 2, 3, 5, 30])):
            size = random.choice([20, 21, 22, 40, 43, 100, 104, 110, 300])
            place, digest = random.randrange(jaccard_join.prefix_length(size, 90)), random.randbytes(16)
            rows += [(token, digest, size, place)] * random.choice([1, 1, 2])  # the same set from two chunks
    rows.sort(key=lambda r: (r[0], r[2], r[1]))
    lists, rows_of = {}, {}
    for r in rows:
        lists.setdefault(r[0], set()).add(r)
    fits = lambda a, b: min(a[2] - a[3], b[2] - b[3]) >= jaccard_join.needed(a[2], b[2], 90)
    wanted = {a for of_token in lists.values() for a in of_token if any(a != b and fits(a, b) for b in of_token)}
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.binary(), pa.int32(), pa.int32()])], names=["token", "digest", "size", "place"])
    for step in (1, 3, 7, len(rows)):
        found = [r for b in jaccard_join._lists(90)(iter(table.to_batches(max_chunksize=step))) for r in b.to_pylist()]
        rows_of[step] = [(r["token"], r["digest"], r["size"], r["place"]) for r in found]
        kept = set(rows_of[step])
        assert len(kept) == len(found) and wanted <= kept
        # Long lists may keep more: beyond the rows that are compared, an entry stays for its size alone.
        assert {r for r in kept if len(lists[r[0]]) <= 5} == {r for r in wanted if len(lists[r[0]]) <= 5}
        assert all(not any(h == r["digest"] for h in r["leaders"]) for r in found)
    assert all(x == rows_of[1] for x in rows_of.values())
