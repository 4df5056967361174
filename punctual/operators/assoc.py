"""Correlations as long tables, for whole frames or inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators.encode import assembler
from punctual.operators.gram import gram
from punctual.operators.joins import BROADCAST_ROWS, lookup, spread_lookup
from punctual.operators.keys import running_count
from punctual.staging import stage

#: Columns of many values which are ranked one after the other at most.
BY_ROW = 4


def correlation() -> Column:
    """Correlation from a row of ``gram``; null if either side is constant over the pair's rows."""
    return F.when(F.col("varies"), F.when(F.col("_i") == F.col("_j"), F.col("cxx") / F.col("cxx")).otherwise(
        F.try_divide("cxy", F.sqrt("cxx") * F.sqrt("cyy"))))


def pearson_long(
    df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None, within: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """``(row_feature, column_feature, correlation)`` for every pair, both ways round.

    A pair leaves out the rows where either side is null.
    """
    label = F.array(*[F.lit(n) for n in (names or columns)])
    cells = gram(df, columns, within).select(*within, "_i", "_j", correlation().alias("_r"))
    value = F.col("_r") if digits is None else F.round("_r", digits)

    def cell(a: str, b: str) -> Column:
        return F.struct(
            F.get(label, F.col(a)).alias("row_feature"), F.get(label, F.col(b)).alias("column_feature"),
            value.alias("correlation"),
        )

    both_ways = F.when(F.col("_i") == F.col("_j"), F.array(cell("_i", "_j"))).otherwise(
        F.array(cell("_i", "_j"), cell("_j", "_i"))
    )
    return cells.select(*within, F.inline(both_ways))


def correlations_with(
    df: DataFrame, columns: Sequence[str], target: str, within: Sequence[str] = ()
) -> DataFrame:
    """``(within..., place, correlation)`` of each column (by its place in the list) with the target."""
    last = len(columns)
    pairs = gram(df, [*columns, target], within).filter((F.col("_j") == last) & (F.col("_i") < last))
    return pairs.select(*within, F.col("_i").alias("place"), correlation().alias("correlation"))


def pearson_matrix(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """The same table from the MLlib matrix: one pass however many columns. Every value must be present."""
    names = list(names or columns)
    vectors = assembler(columns).transform(df).select("features")
    matrix = Correlation.corr(vectors, "features", "pearson").head()[0].toArray()
    rows = [
        (a, b, float(matrix[i][j])) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "row_feature string, column_feature string, correlation double")


def average_ranks(
    df: DataFrame, columns: Sequence[str], within: str | None = None, suffix: str = "_rank",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add each value's rank among its column (ties share their mean rank), optionally inside groups.

    Values are counted before they are ordered, so a value filling a third of the rows is one row when ranked. Columns with few
    values get their ranks from broadcast tables. Up to ``BY_ROW`` others are looked up one after the other, the rows moving once for
    each. The cells of more than those look theirs up together, in one lookup which spreads hot values (see ``lookup``), and meet again
    by row: the number of shuffles does not follow the number of columns. The result is written, since its readers take several passes.
    """
    group = F.col(within) if within else F.lit(0)

    def cells(places: Sequence[int]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("f"), F.col(columns[i]).cast("double").alias("v")) for i in places])

    counts = stage(
        df.select(group.alias("_w"), F.inline(cells(range(len(columns))))).filter(F.col("v").isNotNull() & F.col("_w").isNotNull())
        .groupBy(F.struct("_w", "f").alias("_g"), "v").agg(F.count(F.lit(1)).alias("n")), "rank-counts")
    ranked = stage(running_count(counts, "_g", "v", "n", "_before").select(
        F.col("_g.f").alias("f"), F.struct(F.col("_g._w").alias("w"), "v").alias("_key"),
        (F.col("_before") + (F.col("n") + 1) / 2).alias("_rank"), "n"), "ranks")
    sizes = {r["f"]: (r["k"], r["n"]) for r in ranked.groupBy("f").agg(F.count("f").alias("k"), F.sum("n").alias("n")).collect()}
    many = [i for i in range(len(columns)) if sizes.get(i, (0, 0))[0] > broadcast_rows]
    result = df
    for i, c in enumerate(columns):
        if i not in many:
            key = F.when(F.col(c).isNotNull(), F.struct(group.alias("w"), F.col(c).cast("double").alias("v")))
            table = ranked.filter(F.col("f") == i).select("_key", F.col("_rank").alias(f"{c}{suffix}"))
            result = result.withColumn("_key", key).join(F.broadcast(table), "_key", "left").drop("_key")
    if 0 < len(many) <= BY_ROW:
        for i in many:
            c = columns[i]
            table = ranked.filter(F.col("f") == i).select(
                F.col("_key.v").alias("_v"), F.col("_key.w").alias("_w"), F.col("_rank").alias(f"{c}{suffix}"), (F.col("n") / F.lit(sizes[i][1])).alias("_share"))
            asked = result.withColumns({"_v": F.col(c).cast("double"), "_w": group})
            result = spread_lookup(asked, table, ["_v", "_w"], f"{c}{suffix}", "_share", broadcast_rows).drop("_v", "_w")
    elif many:
        total = sum(sizes[i][1] for i in many)
        rows = stage(result.withColumn("_row", F.monotonically_increasing_id()), "rank-rows")
        table = ranked.filter(F.col("f").isin(many)).select(
            F.struct("f", F.col("_key.w").alias("w"), F.col("_key.v").alias("v")).alias("_key"), "_rank", (F.col("n") / F.lit(total)).alias("_share"))
        asked = rows.select("_row", group.alias("_w"), F.inline(cells(many))).filter(F.col("v").isNotNull() & F.col("_w").isNotNull()).select(
            "_row", "f", F.struct("f", F.col("_w").alias("w"), "v").alias("_key"))
        found = lookup(asked, table, "_key", weight="_share", max_rows=broadcast_rows)
        by_row = found.groupBy("_row").agg(*[F.max(F.when(F.col("f") == i, F.col("_rank"))).alias(f"{columns[i]}{suffix}") for i in many])
        result = rows.join(by_row, "_row", "left").drop("_row")
    return stage(result.select(*df.columns, *[f"{c}{suffix}" for c in columns]), "ranked")


def spearman_long(
    df: DataFrame, columns: Sequence[str], within: str | None = None, digits: int | None = None
) -> DataFrame:
    """Rank correlation of every pair, in the form of ``pearson_long``. Rows with a null are left out."""
    ids = [within] if within else []
    complete = df.select(*ids, *columns).dropna(subset=[*ids, *columns])
    ranks = [f"{c}_rank" for c in columns]
    ranked = average_ranks(complete, columns, within)
    # Callers read the correlations several times.
    return stage(pearson_long(ranked, ranks, columns, ids, digits), "correlations")


def high_pairs(long: DataFrame, features: Sequence[str], threshold: float = 0.8, digits: int = 4) -> DataFrame:
    """Pairs above the threshold, each once, in the given feature order."""
    place = F.create_map(*[x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i))])
    kept = long.filter(F.col("row_feature").isin(*features) & F.col("column_feature").isin(*features))
    return (
        kept.filter(
            (place[F.col("row_feature")] < place[F.col("column_feature")])
            & (F.abs("correlation") > threshold) & ~F.isnan("correlation")
        )
        .select(
            F.col("row_feature").alias("first"), F.col("column_feature").alias("second"),
            F.round("correlation", digits).alias("correlation"),
        )
    )


def prune_pairs(
    long: DataFrame, features: Sequence[str], target: str, threshold: float = 0.8, digits: int = 4
) -> DataFrame:
    """For each high pair, the feature to drop: the one correlating less with the target, the second on a tie."""
    pairs = high_pairs(long, features, threshold, digits)
    strength = long.filter(F.col("column_feature") == target).select(
        "row_feature", F.round(F.abs(F.coalesce(F.nanvl("correlation", F.lit(0.0)), F.lit(0.0))), digits).alias("strength")
    )
    first = strength.select(F.col("row_feature").alias("first"), F.col("strength").alias("first_target"))
    second = strength.select(F.col("row_feature").alias("second"), F.col("strength").alias("second_target"))
    # Both sides have one row per feature or pair of features.
    return pairs.join(first, "first").join(second, "second").select(
        "first", "second", "correlation", "first_target", "second_target",
        F.when(F.col("first_target") >= F.col("second_target"), F.col("second")).otherwise(F.col("first")).alias("dropped"),
    )


def kept_features(pruned: DataFrame, features: Sequence[str]) -> list[str]:
    """The features left after pruning, in their given order."""
    dropped = {r["dropped"] for r in pruned.select("dropped").distinct().collect()}
    return [f for f in features if f not in dropped]
