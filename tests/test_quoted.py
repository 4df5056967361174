"""Quoted files in parts: the rows of Spark's own reader, wherever the parts begin."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.sources import read_csv
from punctual.sources.quoted import odd_parts, records

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType()), T.StructField("x", T.DoubleType())])


def field(rng):
    kinds = ["plain", "two words", 'say ""hi""', "a,b", "line\nbreak", "many\n\n\nbreaks\n", 'ends with quote"" \n""', "", "crlf\r\nkept", "long " * 60]
    text = rng.choice(kinds)
    return f'"{text}"' if rng.random() < 0.6 or any(c in text for c in ',"\n') else text


def written(tmp_path, seed, files=2, rows=40, end="\n"):
    rng = random.Random(seed)
    for f in range(files):
        lines = ["id,note,x"] + [f"{f * 1000 + i},{field(rng)},{rng.choice(['1.5', '', '-2'])}" for i in range(rows)]
        last = end if end != "\n" or rng.random() < 0.5 else ""
        (tmp_path / f"part{f}.csv").write_bytes((end.join(lines) + last).encode())
    return str(tmp_path)


@pytest.fixture(params=[160, 1 << 20])
def parts_of(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 0}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_rows_of_the_whole_file_reader(spark, rows, tmp_path, parts_of, seed, end):
    path = written(tmp_path, seed, end=end)
    want = read_csv(spark, path, SCHEMA, multi_line=True, whole_files=True)
    got = read_csv(spark, path, SCHEMA, multi_line=True)
    assert got.schema.simpleString() == SCHEMA.simpleString()
    assert rows(got) == rows(want) and got.count() == 80
    if parts_of < 200:
        parts = records(spark, path).select("file", "record").rdd.getNumPartitions()
        assert parts > 4


def test_a_field_over_many_parts_and_breaks_at_their_ends(spark, rows, tmp_path, parts_of):
    long = "x\n" * 400
    for width in range(44, 53):  # line breaks on both sides of every place where a part can begin
        (tmp_path / f"w{width}.csv").write_text("id,note,x\n" + f'1,"{"y" * width}\n{"z" * width}",2\n' * 9 + f'2,"{long}",3\n3,"a ""b"" c",4\n')
    want, got = (read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, whole_files=w) for w in (True, False))
    assert rows(got) == rows(want) and got.filter(F.col("note") == long).count() == 9


def test_odd_files(spark, rows, tmp_path):
    for name, text in {"a": "", "b": "id,note,x\n", "c": "\n\nid,note,x\n\n1,q,2\n\n\n", "d": 'id,note,x\n1,"open\nto the end'}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    got = read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)
    assert [r.id for r in got.collect()].count(1) == 2 and got.filter("note = 'q'").count() == 1


def test_a_header_must_name_the_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,x\n1,a,2\n")
    with pytest.raises(Exception, match="does not name"):
        read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()


def test_plan_has_no_shuffle_of_rows(spark, tmp_path):
    path = written(tmp_path, 5, files=1)
    plan = read_csv(spark, path, SCHEMA, multi_line=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert odd_parts(spark.read.text(path).select(F.lit("f").alias("file"), F.lit(0).alias("part"), "value")).count() == 0
