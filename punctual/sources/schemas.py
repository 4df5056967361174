"""Explicit schemas of the flight inputs, so that no read has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType()}


def _schema(text: str) -> T.StructType:
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Column names and types of the flight data.
FLIGHTS = _schema(
    "YEAR int, MONTH int, DAY int, DAY_OF_WEEK int, AIRLINE string, FLIGHT_NUMBER int, TAIL_NUMBER string, "
    "ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, SCHEDULED_DEPARTURE int, DEPARTURE_TIME int, "
    "DEPARTURE_DELAY int, TAXI_OUT int, WHEELS_OFF int, SCHEDULED_TIME int, ELAPSED_TIME int, AIR_TIME int, "
    "DISTANCE int, WHEELS_ON int, TAXI_IN int, SCHEDULED_ARRIVAL int, ARRIVAL_TIME int, ARRIVAL_DELAY int, "
    "DIVERTED int, CANCELLED int, CANCELLATION_REASON string, AIR_SYSTEM_DELAY int, SECURITY_DELAY int, "
    "AIRLINE_DELAY int, LATE_AIRCRAFT_DELAY int, WEATHER_DELAY int"
)
AIRPORT = _schema("Code string, Description string")
AIRPORT_ID = _schema("Code string, Description string")
CARRIER = _schema("IATA_CODE string, AIRLINE string")
COORDINATES = _schema(
    "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, LATITUDE double, LONGITUDE double"
)
CLUSTER_MAP = _schema("index int, cluster int")


def as_strings(schema: T.StructType) -> T.StructType:
    """The same columns, all text: what a header-only CSV read delivers."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
