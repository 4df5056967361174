"""Calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels with the months (first column) or the hours (first to last) they cover.
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}
DAY_PERIODS = {
    "Early Morning": (4, 7),
    "Morning": (8, 11),
    "Midday": (12, 13),
    "Afternoon": (14, 17),
    "Evening": (18, 20),
    "Night": (21, 23),
}
REMAINING_PERIOD = "Late Night"
FIRST_WEEKEND_DAY = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(month: Column | str) -> Column:
    """Season of a month number; null outside 1 to 12."""
    month = _col(month)
    return F.coalesce(*[F.when(month.isin(*months), F.lit(name)) for name, months in SEASONS.items()])


def day_period(hhmm: Column | str) -> Column:
    """Part of the day of an HHMM clock value; null and 2400 fall into the remaining period."""
    hour = F.floor(_col(hhmm) / 100)
    named = [F.when(hour.between(first, last), F.lit(name)) for name, (first, last) in DAY_PERIODS.items()]
    return F.coalesce(*named, F.lit(REMAINING_PERIOD))


def weekend_flag(day_of_week: Column | str) -> Column:
    """1 on day 6 and 7, where day 1 is Monday."""
    return (_col(day_of_week) >= FIRST_WEEKEND_DAY).cast("int")
