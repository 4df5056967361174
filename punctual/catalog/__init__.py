"""All queries by name."""

from punctual.catalog import (  # noqa: F401  (importing registers the queries)
    association, checks, clusters, coding, encoding, features, keysplits, models, outliers, paths, profiles, relational,
    storage,
)
from punctual.catalog.base import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
