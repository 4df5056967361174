"""From complete flights to a clean edge table: one row per flight between two places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.operators import coherence, features, keys, outliers
from punctual.plans import columns as names
from punctual.plans.preparation import engineer, repair_places
from punctual.staging import stage


def edge_table(
    flights: DataFrame,
    pairs: DataFrame,
    row_key: Sequence[str] = tuple(names.FLIGHT_KEY),
    fraction: float = names.SAMPLE_FRACTION,
    cap_quantile: float = names.CAP_QUANTILE,
    relative_error: float = 0.0,
) -> DataFrame:
    """Sampled flights with repaired places and consistent times, the ends of the edge being the places.

    Clock minutes are not wrapped here, so that 2400 stays behind 2359.
    """
    # Written once: the quantile passes and the result read the sample, not all flights.
    sampled = stage(keys.stable_sample(flights, row_key, fraction), "sample")
    featured = engineer(repair_places(sampled, pairs), wrap=False)
    featured = featured.withColumn("DISTANCE", F.col("DISTANCE").cast("double"))
    capped = outliers.cap_at_quantile(featured, "DISTANCE", cap_quantile, relative_error)
    flagged = features.with_midnight_flag(
        capped, "DEPARTURE_TIME_min", "AIR_TIME", "CROSSES_MIDNIGHT_FLAG", "TOTAL_FLIGHT_MIDNIGHT_min"
    )
    on_time = coherence.drop_early_departures(
        flagged, "DEPARTURE_DELAY", "DEPARTURE_TIME_min", "SCHEDULED_DEPARTURE_min"
    )
    ordered = coherence.time_order(
        on_time,
        "CROSSES_MIDNIGHT_FLAG",
        ("DEPARTURE_TIME_min", "WHEELS_OFF_min"),
        [
            ("WHEELS_OFF", "WHEELS_ON"),
            ("WHEELS_ON", "ARRIVAL_TIME"),
            ("SCHEDULED_DEPARTURE_min", "SCHEDULED_ARRIVAL_min"),
        ],
    )
    return ordered.drop(*names.EDGE_DROPS)
