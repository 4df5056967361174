"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.sources.quoted import read_quoted
from punctual.sources.schemas import as_strings


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
    whole_files: bool = False,
) -> DataFrame:
    """Quoted CSV with a header. Bad fields become null in the permissive mode.

    With ``multi_line=True`` a quoted field may hold a line break; given a schema and the permissive or the failing mode, files
    are split all the same (see ``quoted``). ``whole_files=True`` leaves them to Spark's reader, for which each file is one unit of
    parallelism; that is for files with stray quotes. Without a schema the types are inferred, which reads the input twice, and
    multi-line files as a whole.
    """
    if multi_line and schema is not None and not whole_files and mode != "DROPMALFORMED":
        return read_quoted(spark, path, schema, sep, mode)
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # Spark matches a given schema by position; this makes it compare the header names as well.
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_header_only(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV whose columns arrive as text; with a schema they are cast and malformed text becomes null."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.csv(path)
    raw = reader.schema(as_strings(schema)).option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None) -> DataFrame:
    """Stage table by path. ``fmt="delta"`` works where the Delta package is installed."""
    table = spark.read.format(fmt).load(path)
    return table.select(*columns) if columns else table
