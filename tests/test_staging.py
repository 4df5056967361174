"""Staged tables: what is kept, what is deleted, and the session's settings."""

import os

from pyspark.sql import functions as F

from punctual.staging import CLEANUP, scratch_tables, stage


def _folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scratch_tables_are_deleted_and_others_stay(spark):
    with scratch_tables(spark):
        inner = stage(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count(), "inner")
        kept = stage(inner.filter("k > 0"), "kept", outlives=True)
        folder = _folder(inner)
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert sorted(r.k for r in kept.collect()) == [1, 2]
    outside = stage(spark.range(3), "outside")
    assert os.path.isdir(_folder(outside))


def test_scratch_tables_are_deleted_after_an_error(spark):
    try:
        with scratch_tables(spark):
            folder = _folder(stage(spark.range(3), "inner"))
            raise ValueError("stop")
    except ValueError:
        pass
    assert not os.path.exists(folder)


def test_setting_is_as_before(spark):
    before = spark.conf.get(CLEANUP)
    stage(spark.range(10).repartition(3), "one")
    assert spark.conf.get(CLEANUP) == before
