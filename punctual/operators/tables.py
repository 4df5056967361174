"""Ranked and chart-ready tables. Rows are counted first; only group rows are sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators.joins import BROADCAST_ROWS


def top_groups(
    df: DataFrame, by: Sequence[str], k: int | None = None, measures: dict[str, Column] | None = None,
    order: str = "count", ascending: bool = False,
) -> DataFrame:
    """Group counts (and further measures), ordered by one of them with the group key as tie-break."""
    grouped = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"), *[m.alias(n) for n, m in (measures or {}).items()]
    )
    ordered = grouped.orderBy(F.col(order).asc() if ascending else F.col(order).desc(), *by)
    return ordered.limit(k) if k else ordered


def group_means(df: DataFrame, by: Sequence[str], columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """``avg_<column>`` per group for all columns in one pass."""
    def mean(c: str) -> Column:
        return F.avg(c) if digits is None else F.round(F.avg(c), digits)

    return df.groupBy(*by).agg(*[mean(c).alias(f"avg_{c}") for c in columns])


def top_values_overall(counts: DataFrame, column: str, k: int, count: str = "count") -> DataFrame:
    """The ``k`` values of ``column`` with the largest totals over all groups."""
    totals = counts.groupBy(column).agg(F.sum(count).alias("_total"))
    return totals.orderBy(F.desc("_total"), column).limit(k).select(column)


def counts_of_top_values(df: DataFrame, group: str, column: str, k: int) -> DataFrame:
    """Counts per (group, value), kept for the ``k`` values that are most frequent overall."""
    counts = df.groupBy(group, column).agg(F.count(F.lit(1)).alias("count"))
    tops = top_values_overall(counts, column, k)
    return counts.join(F.broadcast(tops) if k <= BROADCAST_ROWS else tops, column, "left_semi")


def share_inside_group(df: DataFrame, group: str, column: str, k: int, digits: int = 6) -> DataFrame:
    """Share of each top value within its group, over the kept values only."""
    kept = counts_of_top_values(df, group, column, k)
    totals = kept.groupBy(group).agg(F.sum("count").alias("_all"))
    return kept.join(totals, group).select(
        group, column, "count", F.round(F.col("count") / F.col("_all"), digits).alias("share")
    )


def pivot_first(
    long: DataFrame, row: str, column: str, value: str, columns: Sequence, fill: Column | None = None,
    prefix: str = "",
) -> DataFrame:
    """Wide matrix with a column per given value; absent cells take ``fill`` cast to the cell type."""
    wide = long.groupBy(row).pivot(column, list(columns)).agg(F.first(value, ignorenulls=True))
    cell = long.schema[value].dataType

    def filled(c) -> Column:
        return F.col(f"`{c}`") if fill is None else F.coalesce(F.col(f"`{c}`"), fill.cast(cell))

    return wide.select(row, *[filled(c).alias(f"{prefix}{c}") for c in columns])


def category_distribution(df: DataFrame, column: str) -> DataFrame:
    return top_groups(df, [column])
