"""HHMM clock arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 1440


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(hhmm: Column | str) -> Column:
    return F.floor(_col(hhmm) / 100)


def minutes_of_day(hhmm: Column | str, wrap: bool = True) -> Column:
    """Minutes after midnight of an HHMM value. 2400 gives 0 when wrapped and 1440 otherwise."""
    hhmm = _col(hhmm)
    minutes = hhmm - F.floor(hhmm / 100) * 40  # an hour is 100 on the clock and 60 minutes
    return minutes % DAY if wrap else minutes


def wrap_minutes(minutes: Column | str) -> Column:
    """Bring a minute count into one day; a time before midnight wraps to the evening before."""
    return F.pmod(_col(minutes), F.lit(DAY))
