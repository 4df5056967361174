"""Checks that times and delays agree with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.clock import wrap_minutes


def clock_difference(
    df: DataFrame, start: str, shift: str, actual: str, expected: str = "expected", difference: str = "difference",
    reverse: bool = False,
) -> DataFrame:
    """Add the expected clock minute ``(start + shift)``, wrapped to one day, and expected minus actual.

    ``reverse`` gives actual minus expected.
    """
    wanted = wrap_minutes(F.col(start) + F.col(shift))
    gap = F.col(actual) - wanted if reverse else wanted - F.col(actual)
    return df.withColumns({expected: wanted, difference: gap})


def mismatches(df: DataFrame, difference: str = "difference") -> DataFrame:
    return df.filter(f"`{difference}` != 0")


def worst_first(df: DataFrame, difference: str, tie_break: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(F.abs(difference).desc(), *tie_break).limit(k)


def mismatch_summary(df: DataFrame, difference: str = "difference") -> DataFrame:
    return df.agg(
        F.count_if(F.col(difference) != 0).alias("mismatches"), F.count(F.lit(1)).alias("total")
    )


def difference_histogram(df: DataFrame, difference: str = "difference") -> DataFrame:
    return mismatches(df, difference).groupBy(difference).agg(F.count(F.lit(1)).alias("count"))


def early_values(df: DataFrame, delay: str, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations among rows with a negative delay."""
    return df.filter(F.col(delay) < 0).select(delay, *columns).distinct()


def early_count(df: DataFrame, delay: str, below: float) -> DataFrame:
    return df.agg(F.count_if(F.col(delay) < below).alias("early_rows"))


def zero_cause_conflicts(df: DataFrame, causes: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows where every cause is 0 although a scheduled time differs from the actual one."""
    none = F.lit(True)
    for c in causes:
        none = none & (F.col(c) == 0)
    differs = F.lit(False)
    for scheduled, actual in pairs:
        differs = differs | (F.col(scheduled) != F.col(actual))
    return df.filter(none & differs)


def drop_early_departures(df: DataFrame, delay: str, actual_minutes: str, scheduled_minutes: str) -> DataFrame:
    return df.filter((F.col(delay) >= 0) & (F.col(actual_minutes) >= F.col(scheduled_minutes)))


def time_order(
    df: DataFrame, midnight_flag: str, ordered: tuple[str, str], always: Sequence[tuple[str, str]]
) -> DataFrame:
    """Drop rows whose times run backwards.

    The midnight flag excuses only the pair ``ordered``; the ``always`` pairs bind every row. A row is
    kept only if each test is decided: a null that leaves the whole undecided drops it.
    """
    first, then = ordered
    broken = (F.col(midnight_flag) != 1) & (F.col(then) < F.col(first))
    for earlier, later in always:
        broken = broken | (F.col(later) < F.col(earlier))
    return df.filter(~broken)
