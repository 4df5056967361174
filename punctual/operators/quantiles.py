"""Exact order statistics and quantiles by narrowing brackets.

Every pass is one map-side aggregate over the columns; rows are never sorted or shuffled as a whole.
Sketch quantiles give values around the wanted rank, exact counts say how many rows lie below, and only
the rows strictly between the bracket ends remain for the next pass. When few enough remain they are
counted by value and the wanted rank is read off. Ties cost nothing, since a bracket end is counted
apart from its interior.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_ACCURACY = 10_000
INTERIOR_ROWS = 1_000_000


@dataclass
class _Target:
    column: str
    rank: int                 # 1-based rank among the values of the column
    low: Any = None           # exclusive ends of the interior, None = open
    high: Any = None
    upto_low: int = 0         # rows at or below ``low``
    interior: int = 0
    answer: Any = None


def _value(df: DataFrame, column: str) -> Column:
    """The column with NaN read as null."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), F.col(column))
    return F.col(column)


def _interior(value: Column, t: _Target) -> Column:
    inside = value.isNotNull()
    if t.low is not None:
        inside = inside & (value > F.lit(t.low))
    if t.high is not None:
        inside = inside & (value < F.lit(t.high))
    return inside


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Sequence[int]], sizes: Mapping[str, int], interior_rows: int = INTERIOR_ROWS
) -> dict[tuple[str, int], Any]:
    """Value at each 1-based rank of each column; ``sizes`` holds the non-null counts."""
    targets = [
        _Target(c, r, interior=sizes[c]) for c, rs in ranks.items() for r in sorted(set(rs)) if 1 <= r <= sizes[c]
    ]
    open_targets = [t for t in targets if t.interior > interior_rows]
    while open_targets:
        _narrow(df, open_targets)
        open_targets = [t for t in open_targets if t.answer is None and t.interior > interior_rows]
    _finish(df, [t for t in targets if t.answer is None])
    return {(t.column, t.rank): t.answer for t in targets}


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    margin = 3.0 / SKETCH_ACCURACY
    # Targets of one column sharing an interior share a sketch.
    interiors: dict[tuple, list[int]] = {}
    for i, t in enumerate(targets):
        interiors.setdefault((t.column, t.low, t.high), []).append(i)
    sketches = []
    for g, members in enumerate(interiors.values()):
        shares = [(targets[i].rank - targets[i].upto_low) / targets[i].interior for i in members]
        value = _value(df, targets[members[0]].column)
        ends = [e for s in shares for e in (max(0.0, s - margin), min(1.0, s + margin))]
        inside = F.when(_interior(value, targets[members[0]]), value)
        sketches.append(F.percentile_approx(inside, ends, SKETCH_ACCURACY).alias(f"s{g}"))
    row = df.agg(*sketches).first()
    brackets = {}
    for g, members in enumerate(interiors.values()):
        for n, i in enumerate(members):
            brackets[i] = (row[f"s{g}"][2 * n], row[f"s{g}"][2 * n + 1])
    counts = []
    for i, t in enumerate(targets):
        low, high = brackets[i]
        value = _value(df, t.column)
        counts += [
            F.count_if(value < F.lit(low)).alias(f"b{i}"),
            F.count_if(value == F.lit(low)).alias(f"l{i}"),
            F.count_if((value > F.lit(low)) & (value < F.lit(high))).alias(f"m{i}"),
            F.count_if(value == F.lit(high)).alias(f"h{i}"),
        ]
    row = df.agg(*counts).first()
    for i, t in enumerate(targets):
        low, high = brackets[i]
        below, at_low, middle, at_high = (row[f"{k}{i}"] for k in "blmh")
        if t.rank <= below:                    # the sketch overshot: keep what lies under the bracket
            t.high, t.interior = low, below - t.upto_low
        elif t.rank <= below + at_low:
            t.answer = low
        elif t.rank <= below + at_low + middle:
            t.low, t.high, t.upto_low, t.interior = low, high, below + at_low, middle
        elif t.rank <= below + at_low + middle + at_high:
            t.answer = high
        else:                                  # undershot: keep what lies above it
            passed = below + at_low + middle + (at_high if high != low else 0)
            t.low, t.interior, t.upto_low = high, t.interior - (passed - t.upto_low), passed


def _finish(df: DataFrame, targets: list[_Target]) -> None:
    if not targets:
        return
    # Targets of one column sharing an interior are answered from the same value counts.
    interiors: dict[tuple, list[_Target]] = {}
    for t in targets:
        interiors.setdefault((t.column, t.low, t.high), []).append(t)
    groups = list(interiors.values())
    by_type: dict[str, list[int]] = {}
    for g, members in enumerate(groups):
        by_type.setdefault(df.schema[members[0].column].dataType.simpleString(), []).append(g)
    for ids in by_type.values():
        tagged = []
        for g in ids:
            t = groups[g][0]
            value = _value(df, t.column)
            tagged.append(F.when(_interior(value, t), F.struct(F.lit(g).alias("g"), value.alias("v"))))
        one = df.select(F.explode(F.array_compact(F.array(*tagged))).alias("x")).select("x.g", "x.v")
        counted = one.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
        upto = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("g").orderBy("v")))
        wanted = F.lit(False)
        for g in ids:
            for t in groups[g]:
                residual = t.rank - t.upto_low
                wanted = wanted | (
                    (F.col("g") == g) & (F.col("upto") >= residual) & (F.col("upto") - F.col("n") < residual)
                )
        for row in upto.filter(wanted).collect():
            for t in groups[row["g"]]:
                residual = t.rank - t.upto_low
                if row["upto"] - row["n"] < residual <= row["upto"]:
                    t.answer = row["v"]


def value_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of values of each column, null and NaN left out; one pass."""
    return df.agg(*[F.count(_value(df, c)).alias(c) for c in columns]).first().asDict()


def quantiles(
    df: DataFrame,
    probs: Mapping[str, Sequence[float]],
    relative_error: float = 0.0,
    interpolate: bool = False,
    interior_rows: int = INTERIOR_ROWS,
) -> dict[tuple[str, float], Any]:
    """Quantiles of several columns as ``{(column, p): value}``; a column without values gives None.

    With ``relative_error`` 0 they are exact: the smallest value whose rank reaches ``p * n``, or, with
    ``interpolate``, the linear interpolation between neighbouring ranks. A positive error takes one
    sketch pass.
    """
    columns = list(probs)
    if relative_error > 0:
        accuracy = math.ceil(1 / relative_error)
        row = df.agg(
            *[F.percentile_approx(_value(df, c), list(probs[c]), accuracy).alias(c) for c in columns]
        ).first()
        return {(c, p): (row[c][i] if row[c] else None) for c in columns for i, p in enumerate(probs[c])}

    sizes = value_counts(df, columns)
    ranks: dict[str, list[int]] = {}
    for c in columns:
        for p in probs[c]:
            if interpolate:
                spot = p * (sizes[c] - 1)
                ranks.setdefault(c, []).extend([math.floor(spot) + 1, math.ceil(spot) + 1])
            else:
                ranks.setdefault(c, []).append(disc_rank(p, sizes[c]))
    found = order_statistics(df, ranks, sizes, interior_rows)
    result: dict[tuple[str, float], Any] = {}
    for c in columns:
        for p in probs[c]:
            if sizes[c] == 0:
                result[c, p] = None
            elif interpolate:
                spot = p * (sizes[c] - 1)
                low, high = found[c, math.floor(spot) + 1], found[c, math.ceil(spot) + 1]
                result[c, p] = float(low) + (float(high) - float(low)) * (spot - math.floor(spot))
            else:
                result[c, p] = found[c, disc_rank(p, sizes[c])]
    return result


def disc_rank(p: float, n: int) -> int:
    """Rank of the discrete quantile: ``p * n`` rounded up, in whole numbers, with ``p`` as the decimal it is written as."""
    share = Fraction(str(p))
    return min(max(-(-share.numerator * n // share.denominator), 1), n)
