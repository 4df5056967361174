"""The most frequent values of a many-valued key, without a count of every value.

Counters of a fixed number of slots tell how many rows fall into a slot; that is at least the count of each value in it. Two
lines of slots by different hashes bound a value by the smaller of its two. The values of the heaviest slots are counted
exactly; the k-th count among them is a threshold that the true k-th reaches. Only rows whose slots all reach it can belong to the
k most frequent values, and only these are shuffled by value. Where counts are so even that the bound does not tell values
apart, all rows pass, and the result is the full count; it is exact in every case.

Counters can be added up: those of days make those of a month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.staging import scratch_tables, stage

#: Slots of a line, and lines. All counters are ``SLOTS * LINES`` short rows, whatever the input.
SLOTS, LINES = 1 << 16, 2
#: Slots of each line whose values are counted for the threshold, for each value that is asked for.
PROBES = 4


def _slot(columns: Sequence[str], line: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(line), *columns), F.lit(slots))


def slot_counts(df: DataFrame, columns: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``line``, ``slot``, ``n``: rows in each slot that has any."""
    cells = F.array(*[F.struct(F.lit(i).alias("line"), _slot(columns, i, slots).alias("slot")) for i in range(LINES)])
    return df.select(F.inline(cells)).groupBy("line", "slot").agg(F.count(F.lit(1)).alias("n"))


def added(counters: DataFrame) -> DataFrame:
    """The counters of several parts as one."""
    return counters.groupBy("line", "slot").agg(F.sum("n").alias("n"))


def rows_in(df: DataFrame, columns: Sequence[str], chosen: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The keys of rows whose slots are chosen in every line. ``chosen``: ``line``, ``slot``; a bounded number of rows."""
    out = df.select(*columns)
    for i in range(LINES):
        picked = chosen.filter(F.col("line") == i).select(F.col("slot").alias("_slot"))
        out = out.join(F.broadcast(picked), _slot(columns, i, slots) == F.col("_slot"), "left_semi")
    return out


def reached(df: DataFrame, columns: Sequence[str], k: int, counters: DataFrame, slots: int = SLOTS) -> int:
    """A count which the k-th most frequent value reaches; 0 if the heaviest slots hold fewer than k values."""
    heaviest = None
    for i in range(LINES):
        some = counters.filter(F.col("line") == i).orderBy(F.desc("n"), "slot").limit(PROBES * k)
        heaviest = some if heaviest is None else heaviest.unionByName(some)
    probed = _counted(rows_in(df, columns, heaviest, slots), columns).orderBy(F.desc("count")).limit(k)
    row = probed.agg(F.count(F.lit(1)).alias("values"), F.min("count").alias("least")).first()
    return row["least"] if row["values"] == k else 0


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, columns: Sequence[str], k: int, slots: int = SLOTS, counters: DataFrame | None = None) -> DataFrame:
    """``columns...``, ``count``: the ``k`` most frequent values, most first, ties by the key.

    A null is a value like others. ``counters`` are those of ``slot_counts`` over the same rows, if they are at hand.
    ``df`` is read three times (twice with ``counters``), each time the key columns only, so stage a costly one.
    """
    with scratch_tables(df.sparkSession):
        counters = stage(slot_counts(df, columns, slots) if counters is None else counters, "slots", outlives=True)
        least = reached(df, columns, k, counters, slots)
    rows = rows_in(df, columns, counters.filter(F.col("n") >= least), slots) if least else df.select(*columns)
    return _counted(rows, columns).orderBy(F.desc("count"), *columns).limit(k)
