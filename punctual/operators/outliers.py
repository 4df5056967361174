"""Caps, tail reports and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators.profile import numeric_columns, percent
from punctual.operators.quantiles import quantiles

# Quantiles of the tail report and the whisker length of a box plot.
REPORT_QUANTILES = (0.25, 0.5, 0.75, 0.95, 0.975, 0.99)
WHISKER = 1.5


def fit_cap(df: DataFrame, column: str, p: float, relative_error: float = 0.0) -> Any:
    """Threshold at quantile ``p``; fit it on the training frame and apply it to all frames."""
    return quantiles(df, {column: [p]}, relative_error)[column, p]


def cap_above(df: DataFrame, column: str, threshold: Any) -> DataFrame:
    """Replace larger values by the threshold. A null stays null."""
    if threshold is None:
        return df
    capped = F.when(F.col(column) > threshold, F.lit(threshold)).otherwise(F.col(column))
    return df.withColumn(column, capped)


def cap_at_quantile(df: DataFrame, column: str, p: float, relative_error: float = 0.0) -> DataFrame:
    return cap_above(df, column, fit_cap(df, column, p, relative_error))


def quartile_report(df: DataFrame, column: str, relative_error: float = 0.0) -> DataFrame:
    """Quartiles, upper quantiles, inter-quartile range and the share of rows above two of them: one row."""
    q = {p: v for (_, p), v in quantiles(df, {column: list(REPORT_QUANTILES)}, relative_error).items()}
    n = F.count(F.lit(1))

    def above(p: float):
        return percent(F.count_if(F.col(column) > F.lit(q[p])), n)

    def value(p: float):
        return F.lit(q[p]).cast("double")

    tails = df.agg(above(0.95).alias("above_p95_percent"), above(0.975).alias("above_p975_percent"))
    return tails.select(
        value(0.25).alias("q1"), value(0.5).alias("median"), value(0.75).alias("q3"),
        F.round(value(0.75) - value(0.25), 6).alias("iqr"),
        value(0.95).alias("p95"), value(0.975).alias("p975"), value(0.99).alias("p99"),
        "above_p95_percent", "above_p975_percent",
    )


def box_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Box-plot numbers of each numeric column: quartiles, whisker ends and the rows beyond them."""
    columns = list(columns or numeric_columns(df))
    q = quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns}, interpolate=True)
    boxes = []
    for c in columns:
        q1, q2, q3 = (q[c, p] for p in (0.25, 0.5, 0.75))
        if q1 is None:
            continue
        low, high = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
        present = F.when(~F.isnan(F.col(c).cast("double")), F.col(c))  # quartiles leave NaN out, and so do the rest
        inside = present.between(low, high)
        boxes.append(
            F.struct(
                *[F.lit(float(x)).alias(n) for n, x in (("q1", q1), ("median", q2), ("q3", q3))],
                F.min(F.when(inside, F.col(c))).cast("double").alias("whisker_low"),
                F.max(F.when(inside, F.col(c))).cast("double").alias("whisker_high"),
                F.count_if(~inside).alias("outliers"),
            ).alias(c)
        )
    kept = [c for c in columns if q[c, 0.25] is not None]
    return df.agg(*boxes).unpivot([], kept, "column", "box").select("column", "box.*")


def filter_min(df: DataFrame, column: str, floor: float) -> DataFrame:
    """Keep rows at or above the floor; null is dropped."""
    return df.filter(F.col(column) >= floor)
