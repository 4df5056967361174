"""Registry of runnable queries. Each may carry an SQL twin that gives the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable:
    """Register a query; ``covers`` lists the inventory ids it exercises."""
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql, tuple(covers.split()))
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL fragments ------------------------------------------------------------------------------

def sql_round(value: str, digits: int) -> str:
    """Round half up in decimal, as Spark does."""
    return f"cast(round(cast({value} as decimal(30,12)), {digits}) as double)"


def sql_percent(part: str, whole: str, digits: int = 2) -> str:
    return sql_round(f"({part}) * 100e0 / ({whole})", digits)


def sql_hash(*keys: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('-', {', '.join(keys)})), 1, 8) as bigint)"


def sql_union(parts: list[str]) -> str:
    return " union all ".join(parts)
