"""A row key that does not depend on how rows are laid out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def stable_hash(*keys: Column | str) -> Column:
    """Uniform number in [0, 2^32) from the business key; the same on every layout and every run."""
    text = F.concat_ws("-", *[F.col(k).cast("string") if isinstance(k, str) else k for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
