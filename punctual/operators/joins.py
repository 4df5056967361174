"""Lookup joins that hold when the lookup outgrows a broadcast and when keys are skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What is broadcast has at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in a broadcast table: 16 for each column, and what its value holds beyond that."""
    out = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            out = out + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("value")))), F.lit(0))
    return out


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Count the rows and their bytes, per task and then in sum, to see whether the frame may be broadcast."""
    size = small.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(small)).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, keep: bool = False) -> DataFrame:
    """Broadcast hint if the measured size allows it, else the frame as it is (AQE then decides).

    ``keep`` caches an aggregated frame, so that measuring and joining compute it once.
    """
    small = small.persist() if keep else small
    return F.broadcast(small) if fits_broadcast(small, max_rows) else small


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str,
    weight: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Left join of a table with one row per ``on`` value.

    Whether the table may be broadcast is measured, unless the caller has counted it (``small``).

    A small table is broadcast. Otherwise ``weight`` (the row share of each value, adding up to 1)
    tells the hot values: those above ``1 / max_rows`` can be at most ``max_rows`` many, so they are
    broadcast, and only the rows of the other values are shuffled. Rows served by the broadcast, and rows
    with a null key, stay where they are. ``df`` is read once for each of the two, so stage a costly one.
    """
    values = [c for c in table.columns if c != on]
    if fits_broadcast(table, max_rows) if small is None else small:
        return df.join(F.broadcast(table), on, "left").select(*df.columns, *[c for c in values if c != weight])
    carried = [c for c in values if c != weight]
    if weight is None:
        return df.join(table.select(on, *carried), on, "left").select(*df.columns, *carried)

    is_hot = F.coalesce(F.col(weight) > 1.0 / max_rows, F.lit(False))
    hot = table.filter(is_hot).select(on, F.struct(*carried).alias("_hot"))
    cold = table.filter(~is_hot).select(on, *carried)
    tried = df.join(F.broadcast(hot), on, "left")
    done = F.col("_hot").isNotNull() | F.col(on).isNull()
    served = tried.filter(done).select(*df.columns, *[F.col("_hot")[c].alias(c) for c in carried])
    rest = tried.filter(~done).select(*df.columns).join(cold, on, "left").select(*df.columns, *carried)
    return served.union(rest)


def spread_lookup(df: DataFrame, table: DataFrame, on: Sequence[str], value: str, weight: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of ``value`` from a table with one row for each of the values of ``on``, which aren't null there, in one shuffle of the rows.

    Hot values (see ``lookup``) come by broadcast; their rows, and those with a null key, are dealt out by number and not by key.
    """
    is_hot = F.coalesce(F.col(weight) > 1.0 / max_rows, F.lit(False))
    hot = table.filter(is_hot).select(*[F.col(k).alias(f"_hot_{k}") for k in on], F.col(value).alias("_hot"))
    cold = table.filter(~is_hot).select(*[F.col(k).alias(f"_cold_{k}") for k in on], F.col(value).alias("_cold"), F.lit(-1).cast("long").alias("_cold_spread"))
    tried = df.join(F.broadcast(hot), [F.col(k) == F.col(f"_hot_{k}") for k in on], "left").drop(*[f"_hot_{k}" for k in on])
    done = F.col("_hot").isNotNull()
    for k in on:
        done = done | F.col(k).isNull()
    dealt = tried.withColumn("_spread", F.when(done, F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long")))
    match = [F.col("_spread") == F.col("_cold_spread"), *[F.col(k) == F.col(f"_cold_{k}") for k in on]]
    return dealt.join(cold, match, "left").select(*df.columns, F.coalesce("_hot", "_cold").alias(value))


def rows_of(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (one row per key there), without widening them."""
    return df.join(keys.select(*on), list(on), "left_semi")


def rows_not_of(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_anti")


def join_on_text(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join of two small dimensions on a shared description."""
    return left.join(right, on, "inner")
