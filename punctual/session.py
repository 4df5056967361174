"""Session defaults for running the package on its own.

Nothing in the package needs these settings; a caller may pass any session.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "punctual", master: str | None = None, **conf: object) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()
