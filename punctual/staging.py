"""Written intermediate tables.

A staged table cuts the lineage and freezes values which a recomputed partition could change
(partition numbers, positions). It lies in the folder named by ``spark.checkpoint.dir``, so it
outlives any executor. Once it is written, the shuffle files behind it are of no more use, and Spark removes them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None

#: Spark's setting that removes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _writers = threading.Lock(), {"n": 0, "before": "false"}
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def staging_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder which all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="punctual-stage-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The setting for as long as any thread writes a staged table; afterwards it is what it was."""
    with _writing:
        if not _writers["n"]:
            _writers["before"] = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _writers["n"] += 1
    try:
        yield
    finally:
        with _writing:
            _writers["n"] -= 1
            if not _writers["n"]:
                spark.conf.set(CLEANUP, _writers["before"])


@contextmanager
def listed_tables() -> Iterator[list[str]]:
    """The paths of the tables staged inside, for ``delete_tables``."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield paths
    finally:
        _scopes.reset(token)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, but for those staged with ``outlives``, which what leaves may read."""
    with listed_tables() as paths:
        try:
            yield
        finally:
            delete_tables(spark, paths)


def stage(df: DataFrame, label: str, partition_by: str | None = None, outlives: bool = False) -> DataFrame:
    """Write ``df`` as parquet under the staging folder and return the table read back."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _shuffles_removed(spark):
        writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    return staged.select(*df.columns)
