from punctual.functions.calendar import day_period, season, weekend_flag
from punctual.functions.clock import hour_of_day, minutes_of_day, wrap_minutes
from punctual.functions.hashing import HASH_SPACE, stable_hash
from punctual.functions.text import is_numeric_code, prefixed, route, unprefixed

__all__ = [
    "HASH_SPACE", "day_period", "hour_of_day", "is_numeric_code", "minutes_of_day", "prefixed",
    "route", "season", "stable_hash", "unprefixed", "weekend_flag", "wrap_minutes",
]
