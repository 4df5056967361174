"""Rows that occur more than once, found without shuffling the rows that don't.

Rows are told apart by a 64-bit hash first. Only hashes are shuffled, summed up before they are, and those met twice point out the
rows worth comparing. Different rows may share a hash, so the rows pointed out are compared as they are; equal rows always share
theirs, so none is missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators.joins import BROADCAST_ROWS
from punctual.staging import stage

#: Keys narrower than this many bytes are as cheap to shuffle as their hash and count.
NARROW_BYTES = 32
_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8}


def is_wide(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether rows of these columns are wider than a hash and a count, as far as the types tell (texts and nested values are)."""
    return sum(_WIDTHS.get(type(df.schema[k].dataType), NARROW_BYTES) for k in keys) >= NARROW_BYTES


def row_hash(keys: Sequence[str]) -> Column:
    # The pattern of nulls is part of the hash, which skips nulls itself.
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.concat(*[F.col(f"`{k}`").isNull().cast("int").cast("string") for k in keys]))


def candidates(df: DataFrame, keys: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows whose hash over ``keys`` is met twice: all rows that share their keys, and few others. ``df`` is read twice.

    The hashes met twice are broadcast if their measured number allows it, so rows don't move at all; beyond that, rows are
    shuffled by their hash.
    """
    hashed = df.withColumn("_hash", row_hash(keys))
    twice = stage(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_hash"), "repeated-hashes")
    small = twice.count() <= max_rows
    return hashed.join(F.broadcast(twice) if small else twice, "_hash", "left_semi").drop("_hash")


def groups(df: DataFrame, keys: Sequence[str] | None = None, count: str = "count", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Key groups (all columns by default) that hold more than one row, with their size."""
    keys = list(keys or df.columns)
    rows = df.select(*[F.col(f"`{k}`") for k in keys])
    screened = candidates(rows, keys, max_rows) if is_wide(df, keys) else rows
    return screened.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(count)).filter(F.col(f"`{count}`") > 1)


def rows(df: DataFrame, keys: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All rows, as they came, whose keys are those of another row. Keys with a null are equal to none."""
    whole = df.dropna(subset=list(keys))
    found = candidates(whole, keys, max_rows)
    repeated = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    return found.join(repeated, list(keys), "left_semi").select(*df.columns)
