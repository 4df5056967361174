"""Quantiles from sketches that are kept per group and merged later, without reading rows again.

A sketch of a group and column has a bounded size and answers any quantile with an error in rank. Sketches of days, or of
partitions, make those of months; the same sketches answer later questions, and new days only add theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.staging import stage

#: Size of a sketch; the error in rank falls with it. At this size it stays below ``RANK_ERROR`` of the rows (observed, and far above the usual one).
K, RANK_ERROR = 1000, 0.01


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by...``, ``column``, ``rows``, ``sketch``: one row for each group and column, ready to be written. Nulls and NaN don't count."""
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in value.items()])
    long = df.select(*by, F.inline(cells)).filter(F.col("value").isNotNull())
    return long.groupBy(*by, "column").agg(F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("value", k).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*by, "column").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by...``, ``column``, ``p``, ``value``."""
    answers = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in ps]
    return sketches.select(*by, "column", F.inline(F.array(*answers)))


def rank_errors(df: DataFrame, answers: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by...``, ``column``, ``p``, ``rows``, ``error``: how far the rank of each answer is from the one asked for, as a share of the rows.

    The answers are few: one for each group, column and quantile.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(*by, F.inline(cells)).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    told = stage(answers.groupBy(*by, "column").agg(F.collect_list(F.struct("p", "value")).alias("asked")), "asked")
    joined = long.join(told, [*by, "column"]).select(*by, "column", "x", F.inline("asked"))
    counted = joined.groupBy(*by, "column", "p").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("up_to"))

    def share(c: str) -> Column:
        return F.col(c) / F.col("rows")

    return counted.select(*by, "column", "p", "rows", F.greatest(share("below") - F.col("p"), F.col("p") - share("up_to"), F.lit(0.0)).alias("error"))
