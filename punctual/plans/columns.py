"""Column lists of the flight tables, used by the plans as defaults."""

# Column names of the flight data, grouped by use.
CAUSES = ["AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY"]
PLACES = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]
FLIGHT_KEY = ["YEAR", "MONTH", "DAY", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER", "SCHEDULED_DEPARTURE"]
INDEX_ORDER = ["DAY", "MONTH", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "FLIGHT_NUMBER", "TAIL_NUMBER"]
CLOCKS = {
    "SCHEDULED_DEPARTURE": "SCHEDULED_DEPARTURE_min",
    "SCHEDULED_ARRIVAL": "SCHEDULED_ARRIVAL_min",
    "DEPARTURE_TIME": "DEPARTURE_TIME_min",
    "WHEELS_OFF": "WHEELS_OFF_min",
    "ARRIVAL_TIME": "ARRIVAL_TIME_min",
}
ONE_HOT = ["SEASON", "SCHEDULED_DEPARTURE_PERIOD"]
FREQUENCY = ["FLIGHT_NUMBER", "TAIL_NUMBER", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE"]
AFTER_ARRIVAL = [
    "ELAPSED_TIME", "AIR_TIME", "WHEELS_ON", "TAXI_IN", "ARRIVAL_TIME", "DIVERTED", "CANCELLED", "CANCELLATION_REASON",
]
CLOCK_ORIGINALS = ["SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL", "DEPARTURE_TIME", "WHEELS_OFF"]
TABLE_DROPS = [*AFTER_ARRIVAL, *CLOCK_ORIGINALS, "TAIL_NUMBER", *[f"{c}_index" for c in ONE_HOT]]
EDGE_DROPS = [*CLOCK_ORIGINALS, "DELAYED_DEPARTURE_FLAG", "TOTAL_KNOWN_DELAY", "CANCELLATION_REASON"]
CLUSTER_CATEGORIES = [
    "ROUTE", "DESTINATION_AIRPORT", "ORIGIN_AIRPORT", "AIRLINE", "SEASON", "SCHEDULED_DEPARTURE_PERIOD", "DAY_OF_WEEK",
    "IS_WEEKEND", "DELAYED_DEPARTURE_FLAG", "FLIGHT_NUMBER",
]
NUMBERS = [
    "DEPARTURE_DELAY", "TAXI_OUT", "SCHEDULED_TIME", "DISTANCE", "SCHEDULED_DEPARTURE_min", "SCHEDULED_ARRIVAL_min",
    "DEPARTURE_TIME_min", "WHEELS_OFF_min",
]
FLAGS = ["IS_WEEKEND", "DELAYED_DEPARTURE_FLAG"]
TARGET = "ARRIVAL_DELAY"
CLUSTER_TARGETS = [TARGET, "TOTAL_KNOWN_DELAY", *CAUSES]

# Sampled share, cap quantile and smallest departure delay of the modelling tables.
SAMPLE_FRACTION = 0.05
CAP_QUANTILE = 0.975
DELAY_FLOOR = -10
