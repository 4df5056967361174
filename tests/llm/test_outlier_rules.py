"""The statistics of the quality rules against brute force, and verdicts of small groups."""

import random
import re

from punctual.llm import outlier_rules


def brute(text):
    """n_words, word_chars, n_repeat_words."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = {}
    for i in range(len(words) - outlier_rules.WINDOW + 1):
        windows.setdefault(tuple(words[i:i + outlier_rules.WINDOW]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(outlier_rules.WINDOW)}
    return len(words), sum(map(len, words)), len(covered)


def test_words_at_the_ends_of_a_text(spark):
    line = "f for the whole of a leaf we went far off "
    texts = ["for the whole of", "f f a f", "\x0cabc d\x0c", "\x0b\x0c f \x0c", "f", "\x0c", "", None, line * 3 + "f", "\x0c" + line * 2, "\\ u0 \\", "\tfluff\r\n"]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_repeat_words) for r in outlier_rules.rules(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_a_rare_language_is_not_judged_by_another(spark):
    """49 texts of a language with long words stay as 50 would, and one unlike its language goes from a small group too."""
    rnd = random.Random(3)
    text = lambda low, high, n=60: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(low, high))) for _ in range(n))
    rows = [(i, text(3, 7), "en", "a") for i in range(300)] + [(1000 + i, text(30, 60), "xx", "b") for i in range(49)]
    rows += [(2000 + i, text(3, 7), "en", "c") for i in range(4)] + [(3000, text(200, 300), "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in outlier_rules.rules(df).collect()}
    assert [i for i, k in kept.items() if not k] == [3000]
