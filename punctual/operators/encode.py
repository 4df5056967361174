"""Encoders and scalers: fitted on one frame, applied to all."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.text import prefixed
from punctual.operators.joins import BROADCAST_ROWS, lookup, rows_not_of
from punctual.operators.profile import share_of_total
from punctual.operators.quantiles import quantiles


# --- few-valued columns -------------------------------------------------------------------------

def fit_one_hot(df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Index by frequency, then one-hot. Unseen values index to the extra slot, which has no column.

    Meant for columns with few values, because the labels live in the model; encode many-valued
    columns by frequency instead.
    """
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep"
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vec" for c in columns]
    )
    return Pipeline(stages=[indexer, encoder]).fit(df)


def slot_count(df: DataFrame, vector: str) -> int:
    """Number of slots of a vector column, read from its metadata."""
    return df.schema[vector].metadata["ml_attr"]["num_attrs"]


def slot_names(df: DataFrame, vector: str) -> list[str]:
    """Slot names in slot order, read from the metadata."""
    groups = df.schema[vector].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """One double column per vector slot, all in one projection."""
    array = "_array"
    unpacked = df.withColumn(array, vector_to_array(vector))
    return unpacked.select(*df.columns, *[F.col(array)[i].alias(n) for i, n in enumerate(names)])


# --- many-valued columns ------------------------------------------------------------------------

@dataclass(frozen=True)
class FrequencyModel:
    """Row share per value of a training column, and the share to use for values it lacks."""

    column: str
    table: DataFrame
    fill: float | None
    small: bool | None = None


def frequency_table(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """``(column, <column>_freq)``: share of rows per value, nulls being a value too."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(column, F.round(F.col("count") / total, digits).alias(f"{column}_freq"))


def fit_frequencies(
    df: DataFrame, columns: Sequence[str], digits: int = 6, relative_error: float = 0.0
) -> dict[str, FrequencyModel]:
    """Frequencies of several columns from one scan and one shuffle of value counts.

    The fill is the median over the distinct values of the column.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(columns)])
    counts = df.select(F.inline(cells)).groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.filter(F.col("_i") == 0).agg(F.sum("_n")).scalar()
    # Kept while the tables are applied; a lost block is counted again with the same result.
    shares = counts.withColumn("_f", F.round(F.col("_n") / total, digits)).persist()
    sizes = {r["_i"]: r["k"] for r in shares.groupBy("_i").agg(F.count(F.lit(1)).alias("k")).collect()}
    wide = shares.select(*[F.when(F.col("_i") == i, F.col("_f")).alias(c) for i, c in enumerate(columns)])
    fills = quantiles(wide, {c: [0.5] for c in columns}, relative_error)
    return {
        c: FrequencyModel(
            c,
            shares.filter(F.col("_i") == i).select(
                F.col("_v").cast(df.schema[c].dataType).alias(c), F.col("_f").alias(f"{c}_freq")
            ),
            fills[c, 0.5],
            sizes.get(i, 0) <= BROADCAST_ROWS,
        )
        for i, c in enumerate(columns)
    }


def unseen_fill(frequencies: DataFrame, column: str, relative_error: float = 0.0) -> float:
    """Median over the distinct values, used for values the training frame lacks."""
    return quantiles(frequencies, {f"{column}_freq": [0.5]}, relative_error)[f"{column}_freq", 0.5]


def apply_frequencies(
    df: DataFrame, frequencies: DataFrame | FrequencyModel, column: str | None = None, fill: float | None = None
) -> DataFrame:
    """Attach the frequency of each row's value; with ``fill``, unknown values get that instead of null."""
    small = None
    if isinstance(frequencies, FrequencyModel):
        column, fill, small, frequencies = frequencies.column, frequencies.fill, frequencies.small, frequencies.table
    out = f"{column}_freq"
    weighted = frequencies.withColumn("_share", F.col(out))
    joined = lookup(df, weighted, column, weight="_share", small=small)
    return joined.fillna({out: fill}) if fill is not None else joined


def row_medians(df: DataFrame, columns: Sequence[str], relative_error: float = 0.0) -> DataFrame:
    """``(column, median)`` over rows."""
    found = quantiles(df, {c: [0.5] for c in columns}, relative_error)
    rows = [(c, None if found[c, 0.5] is None else float(found[c, 0.5])) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, median double")


def unseen_values(df: DataFrame, train: DataFrame, column: str, k: int = 5, digits: int = 6) -> DataFrame:
    """The ``k`` most frequent values that the training frame lacks, with their share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    shared = counts.withColumn("frequency", F.round(F.col("count") / counts.agg(F.sum("count")).scalar(), digits))
    unseen = rows_not_of(shared, train.select(column).distinct(), [column])
    return unseen.orderBy(F.desc("count"), column).limit(k)


# --- vectors ------------------------------------------------------------------------------------

def cast_stage(columns: Sequence[str], suffix: str = "_double") -> SQLTransformer:
    """One pipeline stage that casts all given columns."""
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}{suffix}`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")


def assembler(columns: Sequence[str], out: str = "features", on_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=on_invalid)


def fit_scaler(df: DataFrame, columns: Sequence[str], out: str = "scaled", raw: str = "assembled") -> PipelineModel:
    """Centre and divide by the sample standard deviation; a constant column becomes 0."""
    scaler = StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True)
    return Pipeline(stages=[assembler(columns, raw), scaler]).fit(df)


def scaled_columns(df: DataFrame, model: PipelineModel, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Apply a fitted scaler and keep its slots as ``<column>_scaled``."""
    vectors = model.transform(df)
    wide = vector_columns(vectors, model.stages[-1].getOutputCol(), [f"{c}{suffix}" for c in columns])
    return wide.select(*df.columns, *[f"{c}{suffix}" for c in columns])


# --- category documents -------------------------------------------------------------------------

def category_document(df: DataFrame, columns: Sequence[str], out: str = "category_doc") -> DataFrame:
    """``COLUMN_value`` tokens of all columns joined by spaces; the columns themselves stay as they are."""
    return df.withColumn(out, F.concat_ws(" ", *[prefixed(c, F.col(c).cast("string")) for c in columns]))


def tokenise(df: DataFrame, text: str = "category_doc", out: str = "tokens") -> DataFrame:
    """Lower-case and split at whitespace."""
    return Tokenizer(inputCol=text, outputCol=out).transform(df)


def share_table(df: DataFrame, column: str) -> DataFrame:
    return share_of_total(df.groupBy(column).agg(F.count(F.lit(1)).alias("count")))
