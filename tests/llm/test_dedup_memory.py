"""Memory of tasks in exact dedup and of workers that have encoded texts."""

import pyarrow as pa
from pyspark.sql import types as T

from punctual.llm import grace_dedup, pieces


class _Task:
    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 3


def test_representatives_leave_in_parts(monkeypatch):
    monkeypatch.setattr(grace_dedup, "TaskContext", _Task)
    texts = [f"{i % 24} ".ljust(1 << 20, "x") for i in range(30)] + [None, "", "  a", " a"]
    rows = pa.array([{"text": t, "rest": {"none": 0}} for t in texts])
    given = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), rows], names=["id", "row"])
    out = list(grace_dedup._combine(64 << 20, T.LongType())(iter([given])))
    assert max(b.nbytes for b in out) <= 2 * grace_dedup.PART_BYTES
    rows = [r for b in out for r in b.to_pylist()]
    reps = [r for r in rows if r["rep"]]
    assert sorted(r["id"] for r in rows if not r["rep"]) == list(range(len(texts)))
    assert [r["row"]["text"] for r in sorted(reps, key=lambda r: r["number"])] == [*texts[:24], None, "  a"]
    assert [r["size"] for r in sorted(reps, key=lambda r: r["number"])] == [2] * 6 + [1] * 18 + [2, 2]
    numbers = {r["number"]: r["id"] for r in reps}
    assert len(numbers) == 26 and {r["number"] for r in rows if not r["rep"]} == set(numbers)
    assert [r["id"] for r in rows if r["first"]] == sorted(numbers.values())


def test_cached_words_of_a_worker_are_few():
    assert pieces.CACHE_WORDS * 250 <= 64 << 20
