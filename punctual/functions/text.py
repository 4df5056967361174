"""Code and label text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns for a code that starts with digits and for a value behind its prefix.
NUMERIC_CODE = "^[0-9]+"
LAST_SEGMENT = "_([^_]+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric_code(code: Column | str) -> Column:
    """True when the code starts with a digit; ``12A`` counts."""
    return _col(code).rlike(NUMERIC_CODE)


def route(start: Column | str, end: Column | str, separator: str = "_") -> Column:
    return F.concat_ws(separator, _col(start), _col(end))


def prefixed(name: str, value: Column | str | None = None) -> Column:
    """``NAME_value`` token; a null value leaves the bare name."""
    return F.concat_ws("_", F.lit(name), _col(value if value is not None else name))


def unprefixed(token: Column | str) -> Column:
    """Text after the last underscore of a token, empty when there is none."""
    return F.regexp_extract(_col(token), LAST_SEGMENT, 1)
