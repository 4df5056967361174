from pyspark.sql import functions as F

from punctual.operators import codes, encode, joins
from punctual.operators.joins import lookup


def skewed(spark):
    """A third of the rows share one value, some have none."""
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("v"), (F.col("id") % 97).cast("string"))
    )
    return spark.range(3000).withColumn("k", value)


def test_lookup_paths_agree(spark, rows):
    df = skewed(spark)
    table = encode.frequency_table(df, "k").filter("k is null or k <> 'v5'").withColumn("share", F.col("k_freq"))
    small = rows(lookup(df, table, "k", weight="share"))
    assert rows(lookup(df, table, "k", weight="share", max_rows=10)) == small
    assert rows(lookup(df, table.drop("share"), "k", max_rows=10)) == small
    got = {r["k"]: r["k_freq"] for r in lookup(df, table, "k", weight="share", max_rows=10).collect()}
    assert got["hot"] == round(1000 / 3000, 6) and got["v5"] is None and got[None] is None


def test_large_lookup_shuffles_only_unserved_rows(spark):
    df = skewed(spark).select("k")
    table = encode.frequency_table(df, "k").withColumn("share", F.col("k_freq"))
    plan = lookup(df, table, "k", weight="share", max_rows=10)._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    served, rest = (plan.children().apply(i).toString() for i in (0, 1))
    assert served.count("Join ") == served.count("strategy=broadcast") == 1
    assert "Filter isnull(_hot" in rest and "isnotnull(" in rest


CODES = [("10397",), ("ATL",), ("12A",), (None,), ("99999",)]


def test_replace_codes(spark, rows):
    df = spark.createDataFrame(CODES, "a string").withColumn("b", F.lit("10397"))
    pairs = spark.createDataFrame([("10397", "ATL"), ("10397", "AAX"), ("ATL", "no")], "code string, label string")
    got = rows(codes.replace_codes(df, ["a", "b"], pairs), "a", "a_clean", "b_clean")
    assert got == [("10397", "AAX", "AAX"), ("12A", "12A", "AAX"), ("99999", "99999", "AAX"), ("ATL", "ATL", "AAX"), (None, None, "AAX")]
    cleaned = codes.replace_codes(df, ["a"], pairs)
    assert rows(codes.residual_codes(cleaned, ["a_clean"])) == [("a_clean", 2)]
    assert rows(codes.changed_codes(cleaned, ["a"])) == [("10397", "AAX")]
    assert rows(codes.codes_in_use(df, ["a", "b"])) == [("10397",), ("12A",), ("99999",)]


def test_fanout_and_repair(spark, rows):
    df = spark.createDataFrame([(1, "7"), (2, "8"), (3, "7"), (4, "X")], "id int, a string")
    pairs = spark.createDataFrame([("7", "q"), ("7", "p"), ("8", "r")], "code string, label string")
    fanned = codes.replace_codes(df, ["a"], pairs, resolve=False)
    assert fanned.count() == 6
    repaired = codes.resolve_fanout(fanned, ["a"])
    assert rows(repaired) == rows(codes.replace_codes(df, ["a"], pairs))
    assert repaired.count() == 4


def test_map_from_descriptions(spark, rows):
    ids = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "code int, d string")
    labels = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "z")], "label string, d string")
    assert rows(codes.build_code_map(ids, labels, "d", "code", "label")) == [("1", "A"), ("1", "B"), ("3", "A"), ("3", "B")]


def test_rows_of_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(codes.rows_of_duplicate_keys(df, ["k"])) == [(1, "a"), (1, "b")]


def test_few_wide_rows_are_not_broadcast(spark):
    """Size is rows and bytes: a few long texts don't fit where many short rows do."""
    schema = "k int, t string, b binary, a array<string>, `odd``name` string"
    short = spark.createDataFrame([(i, "x", b"y", ["z"], None) for i in range(100)], schema)
    assert joins.fits_broadcast(short, max_bytes=12_000) and not joins.fits_broadcast(short, max_rows=99)
    for wide in [(1, "x" * 20_000, None, None, None), (1, None, b"y" * 20_000, None, None), (1, None, None, ["z" * 50] * 400, None), (1, None, None, None, "o" * 20_000)]:
        assert not joins.fits_broadcast(spark.createDataFrame([wide], schema), max_bytes=12_000)
    assert joins.fits_broadcast(spark.createDataFrame([], schema), max_bytes=0)
