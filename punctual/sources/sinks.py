"""Writers and small result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder of CSV part files with headers."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a stage table and its schema."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def result_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small driver-side results (metrics, importances) as a table. The schema also covers no rows."""
    return spark.createDataFrame(list(rows), schema)
