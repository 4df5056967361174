from pyspark.sql import functions as F

from punctual.functions import (
    day_period, is_numeric_code, minutes_of_day, prefixed, season, stable_hash, unprefixed, weekend_flag, wrap_minutes,
)


def one_column(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_clock_minutes(spark):
    df = one_column(spark, [0, 5, 59, 100, 1359, 2359, 2400, None])
    got = [tuple(r) for r in df.select(minutes_of_day("x"), minutes_of_day("x", wrap=False)).collect()]
    assert got == [(0, 0), (5, 5), (59, 59), (60, 60), (839, 839), (1439, 1439), (0, 1440), (None, None)]


def test_wrap_goes_back_over_midnight(spark):
    assert [r[0] for r in one_column(spark, [-5, 1450, 0]).select(wrap_minutes("x")).collect()] == [1435, 10, 0]


def test_season(spark):
    df = one_column(spark, [*range(0, 14), None])
    got = [r[0] for r in df.select(season("x")).collect()]
    winter, spring, summer, autumn = "Winter", "Spring", "Summer", "Autumn"
    assert got == [None, winter, winter, *[spring] * 3, *[summer] * 3, *[autumn] * 3, winter, None, None]


def test_day_period_edges(spark):
    df = one_column(spark, [359, 400, 759, 800, 1159, 1200, 1359, 1400, 1759, 1800, 2059, 2100, 2359, 2400, 0, None])
    assert [r[0] for r in df.select(day_period("x")).collect()] == [
        "Late Night", "Early Morning", "Early Morning", "Morning", "Morning", "Midday", "Midday", "Afternoon", "Afternoon",
        "Evening", "Evening", "Night", "Night", "Late Night", "Late Night", "Late Night",
    ]


def test_weekend(spark):
    assert [r[0] for r in one_column(spark, [5, 6, 7, None]).select(weekend_flag("x")).collect()] == [0, 1, 1, None]


def test_numeric_code_is_a_prefix_test(spark):
    df = one_column(spark, ["ATL", "10397", "12A", "A12", None], "string")
    assert [r[0] for r in df.select(is_numeric_code("x")).collect()] == [False, True, True, False, None]


def test_prefix_and_undo(spark):
    df = one_column(spark, ["UA", "a_b", "Early Morning", None], "string")
    got = [tuple(r) for r in df.select(prefixed("C_X", F.col("x")), unprefixed(prefixed("C_X", F.col("x")))).collect()]
    assert got == [("C_X_UA", "UA"), ("C_X_a_b", "b"), ("C_X_Early Morning", "Early Morning"), ("C_X", "X")]


def test_hash_is_the_same_on_every_layout(spark):
    df = spark.range(1000).withColumn("h", stable_hash("id"))
    again = spark.range(1000).repartition(7).withColumn("h", stable_hash("id"))
    assert sorted(df.collect()) == sorted(again.collect())
    spread = df.agg(F.avg(F.col("h") / 2**32)).first()[0]
    assert 0.45 < spread < 0.55
