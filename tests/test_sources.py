import pytest
from pyspark.sql import functions as F

from punctual.sources import (
    CLUSTER_MAP, COORDINATES, FLIGHTS, as_strings, read_csv, read_csv_header_only, read_table, write_csv, write_table,
)
from punctual.staging import stage, staging_root


def test_csv_with_bom_crlf_quotes_and_line_break(spark, tmp_path):
    path = tmp_path / "a.csv"
    text = '﻿IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\r\nA,"x, ""y""\nz",C,S,U,1.5,-2\r\nB,n,C,S,U,,bad'
    path.write_bytes(text.encode("utf-8"))
    got = [tuple(r) for r in read_csv(spark, str(path), COORDINATES, multi_line=True).collect()]
    assert got == [("A", 'x, "y"\nz', "C", "S", "U", 1.5, -2.0), ("B", "n", "C", "S", "U", None, None)]
    inferred = read_csv(spark, str(path), multi_line=True)
    assert inferred.columns == COORDINATES.names and dict(inferred.dtypes)["LATITUDE"] == "double"


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("cluster,index\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(path), CLUSTER_MAP).collect()


def test_header_only_csv(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("index,cluster\n1,2\n2,x\n")
    assert read_csv_header_only(spark, str(path)).dtypes == [("index", "string"), ("cluster", "string")]
    assert [tuple(r) for r in read_csv_header_only(spark, str(path), CLUSTER_MAP).collect()] == [(1, 2), (2, None)]
    assert {f.dataType.simpleString() for f in as_strings(FLIGHTS).fields} == {"string"}


def test_csv_round_trip_is_a_folder(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, "line\nbreak")], "i int, s string")
    write_csv(df, str(tmp_path / "out.csv"))
    assert (tmp_path / "out.csv").is_dir()
    assert rows(read_csv(spark, str(tmp_path / "out.csv"), df.schema, multi_line=True)) == rows(df)


def test_table_overwrite_replaces_the_schema(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    other = spark.range(2).withColumn("p", F.col("id") % 2)
    write_table(other, path, partition_by=["p"])
    assert rows(read_table(spark, path, columns=["id", "p"])) == [(0, 0), (1, 1)]


class Settings:
    """Stands in for a session: the setting cannot change once a session runs."""

    def __init__(self, **values):
        self.conf, self.values = self, values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


def test_staging_reads_the_checkpoint_setting(spark):
    assert staging_root(Settings(spark_checkpoint_dir="s3a://shared/x/", spark_master="yarn")) == "s3a://shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(Settings(spark_master="spark://host:7077"))
    staged = stage(spark.range(5), "x")
    assert staged.count() == 5 and staging_root(spark) in staged.inputFiles()[0]
