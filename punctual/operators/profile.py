"""Data-quality profiles. Each profile is one aggregate over all columns, then a reshape of one row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.operators import repeats

ROWS = "_rows"
FLOATING = (T.DoubleType, T.FloatType)


def _long(row: DataFrame, columns: Sequence[str], name: str, value: str, ids: Sequence[str] = ()) -> DataFrame:
    return row.unpivot(list(ids), list(columns), name, value)


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has it. Vectors and text can only be null."""
    if isinstance(df.schema[column].dataType, FLOATING):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; null when there is nothing to divide by."""
    return F.round(F.try_divide(part * 100, whole), digits)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, denominator: int | None = None) -> DataFrame:
    """``(column, missing_percent)``, largest share first.

    The divisor is the frame's own row count unless another ``denominator`` is given, such as the
    row count before a filter.
    """
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias(ROWS), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    whole = F.col(ROWS) if denominator is None else F.lit(denominator)
    return (
        _long(counts, columns, "column", "nulls", [ROWS])
        .select("column", percent(F.col("nulls"), whole).alias("missing_percent"))
        .orderBy(F.desc("missing_percent"), "column")
    )


def typed_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, kind, missing_count)`` for the numeric, string and vector columns."""
    kinds = {}
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        if isinstance(field.dataType, VectorUDT):
            kinds[field.name] = "vector"
        elif isinstance(field.dataType, T.NumericType):
            kinds[field.name] = "numeric"
        elif isinstance(field.dataType, T.StringType):
            kinds[field.name] = "string"
    counts = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in kinds])
    kind = F.coalesce(*[F.when(F.col("column") == c, F.lit(k)) for c, k in kinds.items()])
    return _long(counts, list(kinds), "column", "missing_count").select("column", kind.alias("kind"), "missing_count")


def retention(df: DataFrame, kept: Column) -> DataFrame:
    """Rows in total, kept and dropped by a condition, and the dropped percentage, in one pass."""
    n, k = F.count(F.lit(1)), F.count_if(kept)
    return df.agg(
        n.alias("total_rows"), k.alias("kept_rows"), (n - k).alias("dropped_rows"),
        percent(n - k, n).alias("dropped_percent"),
    )


def all_present(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in dict.fromkeys(columns):
        condition = condition & F.col(c).isNotNull()
    return condition


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None, count: str = "count") -> DataFrame:
    """Key groups (all columns by default) that hold more than one row, with their size (see ``repeats``)."""
    return repeats.groups(df, keys, count)


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, batch: int = 8
) -> DataFrame:
    """``(column, distinct_count)``. Exact counts expand each row once per column, so columns go in batches."""
    columns = list(columns or df.columns)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return _long(row, columns, "column", "distinct_count")
    result = None
    for start in range(0, len(columns), batch):
        some = columns[start:start + batch]
        part = _long(df.agg(*[F.count_distinct(c).alias(c) for c in some]), some, "column", "distinct_count")
        result = part if result is None else result.unionByName(part)
    return result


def distinct_samples(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` smallest distinct values of each column as text: ``(column, value)``."""
    result = None
    for c in columns:
        smallest = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).limit(k)
        part = smallest.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        result = part if result is None else result.unionByName(part)
    return result


def zero_negative_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, has_zero, has_negative, zero_count, negative_count)`` of the numeric columns in one pass."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    counts = df.agg(
        *[
            F.struct(F.count_if(F.col(c) == 0).alias("zero"), F.count_if(F.col(c) < 0).alias("negative")).alias(c)
            for c in columns
        ]
    )
    return _long(counts, columns, "column", "n").select(
        "column",
        (F.col("n.zero") > 0).alias("has_zero"), (F.col("n.negative") > 0).alias("has_negative"),
        F.col("n.zero").alias("zero_count"), F.col("n.negative").alias("negative_count"),
    )


def share_of_total(counts: DataFrame, count: str = "count", share: str = "percentage", digits: int = 2) -> DataFrame:
    """Add each group's percentage of all rows to a table of group counts."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, percent(F.col(count), total, digits))


def stratum_share(df: DataFrame, stratum: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Row count and percentage per stratum, of the whole frame or inside each ``within`` group."""
    counts = df.groupBy(*within, *stratum).agg(F.count(F.lit(1)).alias("count"))
    if not within:
        return share_of_total(counts)
    totals = counts.groupBy(*within).agg(F.sum("count").alias("_all"))
    return (
        counts.join(totals, list(within), "inner")
        .withColumn("percentage", percent(F.col("count"), F.col("_all"))).drop("_all")
    )


def index_uniqueness(df: DataFrame, index: str, within: str | None = None) -> DataFrame:
    """Row count, distinct index count and whether they agree, per split or overall."""
    per_value = df.groupBy(*([within] if within else []), index).agg(F.count(F.lit(1)).alias("_n"))
    # Counting per value first keeps a hot value from reaching one task as many rows.
    per_value = per_value.groupBy(within) if within else per_value.groupBy()
    return per_value.agg(F.sum("_n").alias("rows"), F.count(index).alias("distinct_index")).withColumn(
        "is_unique", F.col("rows") == F.col("distinct_index")
    )


def summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum."""
    return df.agg(
        F.avg(column).alias("mean"), F.stddev(column).alias("stddev"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )


def frame_shapes(frames: dict[str, DataFrame]) -> DataFrame:
    """``(frame, row_count, column_count)`` of several frames."""
    result = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("frame"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        result = part if result is None else result.unionByName(part)
    return result


def schema_table(df: DataFrame) -> DataFrame:
    """``(position, column, dtype)`` of a frame."""
    rows = [(i, c, t) for i, (c, t) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def schema_parity(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per (column, dtype) met in any frame: how many frames have it, and whether all do."""
    seen: dict[tuple[str, str], int] = {}
    for df in frames.values():
        for item in set(df.dtypes):
            seen[item] = seen.get(item, 0) + 1
    rows = [(c, t, n, n == len(frames)) for (c, t), n in sorted(seen.items())]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "column string, dtype string, frames int, in_all boolean")


def validate_schema(frames: dict[str, DataFrame]) -> None:
    """Raise when the frames differ in column count or in any (name, dtype)."""
    named = {name: set(df.dtypes) for name, df in frames.items()}
    first, expected = next(iter(named.items()))
    for name, found in named.items():
        if found != expected:
            raise ValueError(f"{name} differs from {first}: {sorted(found ^ expected)}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
