"""Row-wise features. All are narrow projections; column names are arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.calendar import day_period, season, weekend_flag
from punctual.functions.clock import DAY, hour_of_day, minutes_of_day
from punctual.functions.text import route

# Fixed value: minutes after which a departure counts as delayed.
DELAY_LIMIT = 15


def with_season(df: DataFrame, month: str, out: str = "season") -> DataFrame:
    return df.withColumn(out, season(month))


def with_day_period(df: DataFrame, hhmm: str, out: str = "day_period") -> DataFrame:
    return df.withColumn(out, day_period(hhmm))


def with_weekend_flag(df: DataFrame, day_of_week: str, out: str = "is_weekend") -> DataFrame:
    return df.withColumn(out, weekend_flag(day_of_week))


def with_delay_flag(df: DataFrame, delay: str, limit: int = DELAY_LIMIT, out: str = "delayed") -> DataFrame:
    return df.withColumn(out, (F.col(delay) > limit).cast("int"))


def with_route(df: DataFrame, start: str, end: str, out: str = "route", separator: str = "_") -> DataFrame:
    return df.withColumn(out, route(start, end, separator))


def with_known_delay(df: DataFrame, causes: Sequence[str], out: str = "known_delay") -> DataFrame:
    """Sum of the causes, a missing cause counting as 0."""
    total = F.lit(0)
    for c in causes:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return df.withColumn(out, total)


def with_clock_minutes(df: DataFrame, clocks: Mapping[str, str], wrap: bool = True) -> DataFrame:
    """``{HHMM column: minute column}`` in one projection."""
    return df.withColumns({out: minutes_of_day(c, wrap) for c, out in clocks.items()})


def with_hour(df: DataFrame, hhmm: str, out: str = "hour") -> DataFrame:
    return df.withColumn(out, hour_of_day(hhmm))


def with_midnight_flag(
    df: DataFrame, start_minutes: str, duration: str, out: str = "crosses_midnight", total: str | None = None
) -> DataFrame:
    """1 when the start plus the duration reaches the next day; ``total`` also keeps the sum."""
    reached = F.col(start_minutes) + F.col(duration)
    columns = {out: (reached >= DAY).cast("int")}
    if total:
        columns[total] = reached
    return df.withColumns(columns)


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns known only after the event (or the targets), before modelling."""
    return df.drop(*columns)


def index_first(df: DataFrame, index: str) -> DataFrame:
    return df.select(index, *[c for c in df.columns if c != index])
