"""Row-wise features."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, movements
from punctual.operators import features
from punctual.plans.columns import AFTER_ARRIVAL, CAUSES, CLOCKS

SEASON_SQL = """case when {m} in (12, 1, 2) then 'Winter' when {m} in (3, 4, 5) then 'Spring'
  when {m} in (6, 7, 8) then 'Summer' when {m} in (9, 10, 11) then 'Autumn' end"""
PERIOD_SQL = """case when {c} // 100 between 4 and 7 then 'Early Morning' when {c} // 100 between 8 and 11 then 'Morning'
  when {c} // 100 between 12 and 13 then 'Midday' when {c} // 100 between 14 and 17 then 'Afternoon'
  when {c} // 100 between 18 and 20 then 'Evening' when {c} // 100 between 21 and 23 then 'Night' else 'Late Night' end"""


@query(
    "season", "E1 F5 C7",
    f"select o_orderkey, {SEASON_SQL.format(m='month(o_orderdate)')} as season from orders",
)
def _(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"))
    return features.with_season(months, "month").drop("month")


@query(
    "day_period", "E2 C3 C7",
    f"""select event_id, {PERIOD_SQL.format(c='clock')} as day_period
    from (select event_id, hour(ts) * 100 + minute(ts) as clock from events)""",
)
def _(spark, sf_dir):
    clock = (F.hour("ts") * 100 + F.minute("ts")).alias("clock")
    return features.with_day_period(table(spark, sf_dir, "events").select("event_id", clock), "clock").drop("clock")


@query("weekend", "E3 C8", "select o_orderkey, cast(isodow(o_orderdate) >= 6 as integer) as is_weekend from orders")
def _(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_orderkey", (F.weekday("o_orderdate") + 1).alias("day"))
    return features.with_weekend_flag(days, "day").drop("day")


@query("delay_flag", "E4 C8", "select event_id, value - 50 as delay, cast(value - 50 > 15 as integer) as delayed from events")
def _(spark, sf_dir):
    delays = table(spark, sf_dir, "events").select("event_id", (F.col("value") - 50).alias("delay"))
    return features.with_delay_flag(delays, "delay")


@query(
    "known_delay", "E6 C1 C6",
    f"""{MOVEMENTS} select {LINE_KEY_SQL}, {' + '.join(f'coalesce({c}, 0)' for c in CAUSES)} as known_delay from movements""",
)
def _(spark, sf_dir):
    return features.with_known_delay(movements(spark, sf_dir), CAUSES).select(*LINE_KEY, "known_delay")


def _minutes_sql(wrap: bool) -> str:
    return ", ".join(
        f"cast(({c} // 100 * 60 + {c} % 100){' % 1440' if wrap else ''} as bigint) as {out}" for c, out in CLOCKS.items()
    )


@query("clock_minutes_wrapped", "E7 C2 C3", f"{MOVEMENTS} select {LINE_KEY_SQL}, {_minutes_sql(True)} from movements")
def _(spark, sf_dir):
    return features.with_clock_minutes(movements(spark, sf_dir), CLOCKS).select(*LINE_KEY, *CLOCKS.values())


@query("clock_minutes_raw", "E8", f"{MOVEMENTS} select {LINE_KEY_SQL}, {_minutes_sql(False)} from movements")
def _(spark, sf_dir):
    return features.with_clock_minutes(movements(spark, sf_dir), CLOCKS, wrap=False).select(*LINE_KEY, *CLOCKS.values())


@query(
    "crosses_midnight", "E10",
    f"""{MOVEMENTS} select {LINE_KEY_SQL}, cast(DEPARTURE_TIME // 100 * 60 + DEPARTURE_TIME % 100 + AIR_TIME as bigint)
    as total_minutes, cast(DEPARTURE_TIME // 100 * 60 + DEPARTURE_TIME % 100 + AIR_TIME >= 1440 as integer)
    as crosses_midnight from movements""",
)
def _(spark, sf_dir):
    timed = features.with_clock_minutes(movements(spark, sf_dir), {"DEPARTURE_TIME": "departed"}, wrap=False)
    flagged = features.with_midnight_flag(timed, "departed", "AIR_TIME", total="total_minutes")
    return flagged.select(*LINE_KEY, "total_minutes", "crosses_midnight")


@query(
    "leakage_guard", "E11 P4",
    f"""{MOVEMENTS} select * exclude (ELAPSED_TIME, AIR_TIME, WHEELS_ON, TAXI_IN, ARRIVAL_TIME, DIVERTED, CANCELLED,
    CANCELLATION_REASON) from movements""",
)
def _(spark, sf_dir):
    return features.without(movements(spark, sf_dir), AFTER_ARRIVAL)
