"""Loading filter and the overview tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators.features import with_hour, with_route
from punctual.operators.tables import group_means, top_groups
from punctual.plans import columns as names


def filter_complete(flights: DataFrame, causes: Sequence[str] = tuple(names.CAUSES)) -> DataFrame:
    """Flights whose delay causes are all known."""
    return flights.dropna(how="any", subset=list(causes))


def overview(flights: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Ranked tables for the usual charts; each is small whatever the input holds."""
    arrival: Column = F.avg("ARRIVAL_DELAY")
    routed = with_route(flights, *names.PLACES, out="ROUTE")
    return {
        "top_origins": top_groups(flights, ["ORIGIN_AIRPORT"], k),
        "top_destinations": top_groups(flights, ["DESTINATION_AIRPORT"], k),
        "top_airlines": top_groups(flights, ["AIRLINE"], k),
        "airline_delays": group_means(flights, ["AIRLINE"], ["ARRIVAL_DELAY", "DEPARTURE_DELAY"]),
        "hourly_delay": group_means(with_hour(flights, "SCHEDULED_DEPARTURE", "HOUR"), ["HOUR"], ["DEPARTURE_DELAY"]),
        "top_routes": top_groups(routed, ["ROUTE"], k),
        "worst_routes": top_groups(routed, ["ROUTE"], k, {"avg_ARRIVAL_DELAY": arrival}, order="avg_ARRIVAL_DELAY"),
    }
