"""Repair of coded keys: numeric codes are replaced by their labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.text import is_numeric_code
from punctual.operators import repeats
from punctual.operators.joins import checked_broadcast, join_on_text


def build_code_map(ids: DataFrame, labels: DataFrame, description: str, code: str, label: str) -> DataFrame:
    """``(code, label)`` pairs from two lookups sharing a description; a code may get several labels.

    Codes are text, so that a code such as ``12A`` is simply not found.
    """
    pairs = join_on_text(ids, labels, description)
    return pairs.select(F.col(code).cast("string").alias("code"), F.col(label).alias("label")).distinct()


def preferred_labels(pairs: DataFrame, code: str = "code", label: str = "label") -> DataFrame:
    """One label per code: the smallest."""
    return pairs.groupBy(code).agg(F.min(label).alias(label))


def codes_in_use(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct numeric codes over several columns.

    Each column is reduced to its distinct codes before the union, so the union is small.
    """
    found = None
    for c in columns:
        one = df.select(F.col(c).alias("code")).filter(is_numeric_code("code")).distinct()
        found = one if found is None else found.union(one)
    return found.distinct()


def replace_codes(
    df: DataFrame, columns: Sequence[str], pairs: DataFrame, suffix: str = "_clean", resolve: bool = True
) -> DataFrame:
    """Add ``<column><suffix>`` with the mapped label, or the raw value where no label is known.

    ``pairs`` has columns ``code`` and ``label``. With ``resolve`` it is first brought to one label per
    code, so the row count stays; without, rows multiply by the labels of their code.
    """
    table = preferred_labels(pairs) if resolve else pairs.select("code", "label")
    table = checked_broadcast(table.filter(is_numeric_code("code")))
    result = df
    for i, c in enumerate(columns):
        role = table.select(F.col("code").alias(f"_code{i}"), F.col("label").alias(f"_label{i}"))
        result = result.join(role, F.col(c) == F.col(f"_code{i}"), "left")
    cleaned = [F.coalesce(F.col(f"_label{i}"), F.col(c)).alias(f"{c}{suffix}") for i, c in enumerate(columns)]
    return result.select(*df.columns, *cleaned)


def residual_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, residual)``: rows that still hold a numeric code, per column, in one pass."""
    counts = df.agg(*[F.count_if(is_numeric_code(c)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "residual")


def _differs(columns: Sequence[str], suffix: str) -> Column:
    condition = F.lit(False)
    for c in columns:
        condition = condition | (F.col(c) != F.col(f"{c}{suffix}"))
    return condition


def changed_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_clean") -> DataFrame:
    """Distinct combinations of old and new values on rows where any of them was replaced."""
    pairs = [x for c in columns for x in (c, f"{c}{suffix}")]
    return df.filter(_differs(columns, suffix)).select(*pairs).distinct()


def resolve_fanout(df: DataFrame, columns: Sequence[str], suffix: str = "_clean") -> DataFrame:
    """Undo the row multiplication of an unresolved map: keep rows with the smallest label of each raw code."""
    result = df
    keep = F.lit(True)
    for i, c in enumerate(columns):
        preferred = df.groupBy(F.col(c).alias(f"_raw{i}")).agg(F.min(f"{c}{suffix}").alias(f"_preferred{i}"))
        result = result.join(checked_broadcast(preferred, keep=True), F.col(c) == F.col(f"_raw{i}"), "left")
        keep = keep & (F.col(f"{c}{suffix}") == F.col(f"_preferred{i}"))
    return result.filter(keep).select(*df.columns)


def rows_of_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once (see ``repeats``)."""
    return repeats.rows(df, keys)
