"""A corpus from documents: quality rules, exact and near duplicates, the mix of sources, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again for the next one. Working
tables behind a stage's DataFrame are deleted when a later stage is called, since it has been written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from punctual.llm import apportion, grace_dedup, jaccard_join, outlier_rules, pieces
from punctual.staging import delete_tables, listed_tables, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share 80 % of their shingles of five words; operator 7 alone has its own contract (3 and 90).
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Working tables by the place of their stage.
_working: dict[int, list[str]] = {}


def _stage(place: int) -> Callable:
    def wrap(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for earlier in [p for p in _working if p < place]:
                delete_tables(spark, _working.pop(earlier))
            with listed_tables() as paths:
                out = function(spark, docs, sf_dir)
            _working.setdefault(place, []).extend(paths)
            return out

        return run_stage

    return wrap


@_stage(0)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents which the base rules and the outlier estimate keep."""
    return outlier_rules.kept_documents(docs.select(*COLUMNS))


@_stage(1)
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each text."""
    return grace_dedup.exact_dedup(docs.select(*COLUMNS)).kept_rows


@_stage(2)
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked shingle sets."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS), words=NEAR_WORDS, percent=NEAR_PERCENT)


@_stage(3)
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return apportion.mixed_documents(docs.select(*COLUMNS))


@_stage(4)
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``input_ids``."""
    return pieces.encode(docs.select(*COLUMNS))


STAGES = [
    ("quality rules", quality_rules), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", source_mix), ("SentencePiece encoding and decoding", tokens),
]

#: The estimates, the similarity join and the encoding have no SQL form. Tests hold stage 3 against brute force, of the others only parts; ``run`` is not tested.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
