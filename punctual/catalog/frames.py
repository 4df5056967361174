"""Stand-in flights: the given order tables read as movements between two places.

Every line of an order is one movement. Places are the nations of its supplier and customer, held as
numeric codes in October. All clock values follow from the row's own keys, so the frame grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.catalog.base import table

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = ", ".join(LINE_KEY)
NULLED = "R"  # rows with this return flag have no known causes


def _hhmm(minutes: Column) -> Column:
    """Clock value of a minute; each hour adds 40 to the minute count. Minute 1440 is 2400."""
    return (minutes + F.call_function("div", minutes, F.lit(60)) * 40).cast("int")


def _hhmm_sql(minutes: str) -> str:
    return f"cast({minutes} + ({minutes} // 60) * 40 as integer)"


def _actual(minutes: Column) -> Column:
    """Minute 1 to 1440: an actual time at midnight reads 2400."""
    return (minutes + 1439) % 1440 + 1


def _actual_sql(minutes: str) -> str:
    return f"({minutes} + 1439) % 1440 + 1"


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    def nation(prefix: str) -> DataFrame:
        return table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias(f"{prefix}_nation"), F.col("n_name").alias(f"{prefix}_name")
        )

    lines = table(spark, sf_dir, "lineitem").drop("l_shipdate", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("from_nation"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("to_nation"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation("from"), "from_nation").join(nation("to"), "to_nation")
    )
    month = F.month("o_orderdate")
    steps = joined.select(
        *LINE_KEY, "o_orderpriority", "o_orderdate", "l_extendedprice", "l_returnflag",
        F.when(month == 10, F.col("from_nation").cast("string")).otherwise(F.col("from_name")).alias("origin"),
        F.when(month == 10, F.col("to_nation").cast("string")).otherwise(F.col("to_name")).alias("destination"),
        (F.pmod(F.col("to_nation"), F.lit(3)) * 60 - F.pmod(F.col("from_nation"), F.lit(3)) * 60).alias("zone"),
        ((F.col("l_partkey") * 7 + F.col("l_orderkey") * 13 + F.col("l_linenumber") * 101) % 1440).alias("scheduled"),
        (F.col("l_quantity").cast("int") - 12).alias("delay"),
        (F.col("l_linenumber") + 4).alias("taxi_out"),
        (F.col("l_partkey") % 200 + 30).alias("air"),
        (F.col("l_suppkey") % 7 + 3).alias("taxi_in"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
    )
    departed = F.col("scheduled") + F.col("delay")
    off = departed + F.col("taxi_out")
    landed = off + F.col("air")
    minutes = F.struct(
        F.col("scheduled").alias("scheduled_at"), _actual(departed).alias("departed_at"), _actual(off).alias("off_at"),
        _actual(landed).alias("landed_at"), _actual(landed + F.col("taxi_in")).alias("arrived_at"),
        ((F.col("scheduled") + F.col("air") + 15 + F.col("zone") + 1440) % 1440).alias("due_at"),
    )
    # Unfolding a one-element array keeps filters on clock values above it, so each minute is computed once.
    steps = steps.select("*", F.inline(F.array(minutes)))

    def cause(value: Column) -> Column:
        return F.when(F.col("l_returnflag") != NULLED, value).cast("int")

    return steps.select(
        *LINE_KEY,
        F.year("o_orderdate").alias("YEAR"), F.month("o_orderdate").alias("MONTH"), F.day("o_orderdate").alias("DAY"),
        (F.weekday("o_orderdate") + 1).alias("DAY_OF_WEEK"),
        F.col("o_orderpriority").alias("AIRLINE"),
        F.col("l_suppkey").cast("int").alias("FLIGHT_NUMBER"),
        F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("TAIL_NUMBER"),
        F.col("origin").alias("ORIGIN_AIRPORT"), F.col("destination").alias("DESTINATION_AIRPORT"),
        _hhmm(F.col("scheduled_at")).alias("SCHEDULED_DEPARTURE"),
        _hhmm(F.col("departed_at")).alias("DEPARTURE_TIME"),
        F.col("delay").alias("DEPARTURE_DELAY"),
        F.col("taxi_out").cast("int").alias("TAXI_OUT"),
        _hhmm(F.col("off_at")).alias("WHEELS_OFF"),
        (F.col("air") + 15).cast("int").alias("SCHEDULED_TIME"),
        (F.col("taxi_out") + F.col("air") + F.col("taxi_in")).cast("int").alias("ELAPSED_TIME"),
        F.col("air").cast("int").alias("AIR_TIME"),
        F.floor(F.col("l_extendedprice") / 100).cast("int").alias("DISTANCE"),
        _hhmm(F.col("landed_at")).alias("WHEELS_ON"),
        F.col("taxi_in").cast("int").alias("TAXI_IN"),
        _hhmm(F.col("due_at")).alias("SCHEDULED_ARRIVAL"),
        _hhmm(F.col("arrived_at")).alias("ARRIVAL_TIME"),
        (F.col("delay") + F.col("taxi_out") + F.col("taxi_in") - 15).cast("int").alias("ARRIVAL_DELAY"),
        F.lit(0).alias("DIVERTED"), F.lit(0).alias("CANCELLED"), F.lit(None).cast("string").alias("CANCELLATION_REASON"),
        cause(F.col("tax")).alias("AIR_SYSTEM_DELAY"),
        cause(F.col("discount") % 2).alias("SECURITY_DELAY"),
        cause(F.greatest(F.col("delay"), F.lit(0)) % 5).alias("AIRLINE_DELAY"),
        cause(F.col("discount")).alias("LATE_AIRCRAFT_DELAY"),
        cause(F.col("l_linenumber") % 3).alias("WEATHER_DELAY"),
    )


def _cause_sql(value: str) -> str:
    return f"cast(case when l_returnflag <> '{NULLED}' then {value} end as integer)"


MOVEMENTS = f"""
with steps as (
  select {LINE_KEY_SQL}, o_orderpriority, o_orderdate, l_extendedprice, l_returnflag,
    case when month(o_orderdate) = 10 then cast(fn.n_nationkey as varchar) else fn.n_name end as origin,
    case when month(o_orderdate) = 10 then cast(tn.n_nationkey as varchar) else tn.n_name end as destination,
    (tn.n_nationkey % 3) * 60 - (fn.n_nationkey % 3) * 60 as zone,
    (l_partkey * 7 + l_orderkey * 13 + l_linenumber * 101) % 1440 as scheduled,
    cast(l_quantity as integer) - 12 as delay, l_linenumber + 4 as taxi_out, l_partkey % 200 + 30 as air,
    l_suppkey % 7 + 3 as taxi_in, cast(round(l_tax * 100) as integer) as tax,
    cast(round(l_discount * 100) as integer) as discount
  from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
  join customer on o_custkey = c_custkey join nation fn on fn.n_nationkey = s_nationkey
  join nation tn on tn.n_nationkey = c_nationkey),
steps2 as (select *, {_actual_sql('scheduled + delay')} as departed, {_actual_sql('scheduled + delay + taxi_out')} as off,
  {_actual_sql('scheduled + delay + taxi_out + air')} as on_ground,
  {_actual_sql('scheduled + delay + taxi_out + air + taxi_in')} as arrived,
  (scheduled + air + 15 + zone + 1440) % 1440 as due from steps),
movements as (
  select {LINE_KEY_SQL}, cast(year(o_orderdate) as integer) as YEAR, cast(month(o_orderdate) as integer) as MONTH,
    cast(day(o_orderdate) as integer) as DAY, cast(isodow(o_orderdate) as integer) as DAY_OF_WEEK,
    o_orderpriority as AIRLINE, cast(l_suppkey as integer) as FLIGHT_NUMBER, 'N' || l_partkey as TAIL_NUMBER,
    origin as ORIGIN_AIRPORT, destination as DESTINATION_AIRPORT,
    {_hhmm_sql('scheduled')} as SCHEDULED_DEPARTURE, {_hhmm_sql('departed')} as DEPARTURE_TIME,
    delay as DEPARTURE_DELAY, cast(taxi_out as integer) as TAXI_OUT, {_hhmm_sql('off')} as WHEELS_OFF,
    cast(air + 15 as integer) as SCHEDULED_TIME, cast(taxi_out + air + taxi_in as integer) as ELAPSED_TIME,
    cast(air as integer) as AIR_TIME, cast(floor(l_extendedprice / 100) as integer) as DISTANCE,
    {_hhmm_sql('on_ground')} as WHEELS_ON, cast(taxi_in as integer) as TAXI_IN,
    {_hhmm_sql('due')} as SCHEDULED_ARRIVAL, {_hhmm_sql('arrived')} as ARRIVAL_TIME,
    cast(delay + taxi_out + taxi_in - 15 as integer) as ARRIVAL_DELAY, 0 as DIVERTED, 0 as CANCELLED,
    cast(null as varchar) as CANCELLATION_REASON,
    {_cause_sql('tax')} as AIR_SYSTEM_DELAY, {_cause_sql('discount % 2')} as SECURITY_DELAY,
    {_cause_sql('greatest(delay, 0) % 5')} as AIRLINE_DELAY, {_cause_sql('discount')} as LATE_AIRCRAFT_DELAY,
    {_cause_sql('l_linenumber % 3')} as WEATHER_DELAY
  from steps2)
"""


def place_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code map of the movements: nation number as text to nation name."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )


def fanout_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code map with many labels per code, from the parts: size as text to brand."""
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("code"), F.col("p_brand").alias("label")
    ).distinct()
