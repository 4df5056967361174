"""Data-quality profiles."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_percent, sql_round, sql_union, table
from punctual.catalog.frames import MOVEMENTS, movements
from punctual.operators import profile
from punctual.plans.columns import CAUSES

_LINE = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]


def _holed(spark, sf_dir):
    """Order lines whose zero discount or tax, and return flag N, count as unknown."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
    )


_HOLED = """holed as (select l_orderkey, l_quantity, nullif(l_discount, 0) as l_discount, nullif(l_tax, 0) as l_tax,
  nullif(l_returnflag, 'N') as l_returnflag from lineitem)"""


def _missing_sql(source: str, whole: str) -> str:
    return sql_union(
        [
            f"select '{c}' as \"column\", {sql_percent(f'count(*) filter (where {c} is null)', whole)} "
            f"as missing_percent from {source}"
            for c in _LINE
        ]
    )


@query("missing_profile", "Q1 P9 A6 F14 C4", f"with {_HOLED} {_missing_sql('holed', 'count(*)')}")
def _(spark, sf_dir):
    return profile.missing_profile(_holed(spark, sf_dir))


@query(
    "missing_profile_vs_total", "Q2 P9 F1",
    f"with {_HOLED}, kept as (select * from holed where l_discount is not null) "
    f"{_missing_sql('kept', '(select count(*) from holed)')}",
)
def _(spark, sf_dir):
    df = _holed(spark, sf_dir)
    return profile.missing_profile(df.dropna(subset=["l_discount"]), denominator=df.count())


_ALL_CAUSES = " and ".join(f"{c} is not null" for c in CAUSES)


@query(
    "retention_report", "Q3 F1 A1",
    f"""{MOVEMENTS} select count(*) as total_rows, count(*) filter (where {_ALL_CAUSES}) as kept_rows,
    count(*) filter (where not ({_ALL_CAUSES})) as dropped_rows,
    {sql_percent(f'count(*) filter (where not ({_ALL_CAUSES}))', 'count(*)')} as dropped_percent from movements""",
)
def _(spark, sf_dir):
    return profile.retention(movements(spark, sf_dir), profile.all_present(CAUSES))


_EVENT = ["user_id", "event_type", "hour_value"]


@query(
    "duplicate_rows", "Q4 A18 A9 F8",
    """select user_id, event_type, cast(hour(ts) as integer) as hour_value, count(*) as "count" from events
    group by all having count(*) > 1""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("user_id", "event_type", F.hour("ts").alias("hour_value"))
    return profile.duplicate_groups(df)


@query(
    "duplicate_keys", "Q5 A9",
    """select l_orderkey, l_linenumber, count(*) as "count" from lineitem group by all having count(*) > 1""",
)
def _(spark, sf_dir):
    return profile.duplicate_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_TYPED = {
    "l_orderkey": "numeric", "l_quantity": "numeric", "l_discount": "numeric", "l_tax": "numeric",
    "l_returnflag": "string", "ratio": "numeric",
}


@query(
    "typed_missing", "Q6 F14",
    f"with {_HOLED}, typed as (select *, case when l_quantity = 1 then 'nan'::double else l_quantity end as ratio "
    "from holed) " + sql_union(
        [
            f"select '{c}' as \"column\", '{k}' as kind, count(*) filter (where {c} is null"
            + (f" or isnan({c})" if c == "ratio" else "") + ") as missing_count from typed"
            for c, k in _TYPED.items()
        ]
    ),
)
def _(spark, sf_dir):
    ratio = F.when(F.col("l_quantity") == 1, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return profile.typed_missing(_holed(spark, sf_dir).withColumn("ratio", ratio))


@query(
    "distinct_counts", "Q7 A7",
    sql_union(
        [
            f"select '{c}' as \"column\", count(distinct {c}) as distinct_count from orders"
            for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
        ]
    ),
)
def _(spark, sf_dir):
    return profile.distinct_counts(table(spark, sf_dir, "orders"))


_SAMPLED = ["p_name", "p_brand", "p_type", "p_size"]


@query(
    "distinct_samples", "Q8 A12 S7",
    sql_union(
        [
            f"select * from (select '{c}' as \"column\", cast({c} as varchar) as value from "
            f"(select distinct {c} from part order by {c} limit 10))"
            for c in _SAMPLED
        ]
    ),
)
def _(spark, sf_dir):
    return profile.distinct_samples(table(spark, sf_dir, "part"), _SAMPLED)


_SIGNED = ["DEPARTURE_DELAY", "ARRIVAL_DELAY", "AIR_SYSTEM_DELAY", "LATE_AIRCRAFT_DELAY", "DISTANCE", "SCHEDULED_DEPARTURE"]


@query(
    "zero_negative_profile", "Q9 F7",
    MOVEMENTS + sql_union(
        [
            f"select '{c}' as \"column\", count(*) filter (where {c} = 0) > 0 as has_zero, "
            f"count(*) filter (where {c} < 0) > 0 as has_negative, count(*) filter (where {c} = 0) as zero_count, "
            f"count(*) filter (where {c} < 0) as negative_count from movements"
            for c in _SIGNED
        ]
    ),
)
def _(spark, sf_dir):
    return profile.zero_negative_profile(movements(spark, sf_dir), _SIGNED)


@query(
    "stratum_share", "Q10 A15 A2",
    f"""select cast(month(o_orderdate) as integer) as month, count(*) as "count",
    {sql_percent('count(*)', '(select count(*) from orders)')} as percentage from orders group by 1""",
)
def _(spark, sf_dir):
    return profile.stratum_share(table(spark, sf_dir, "orders").select(F.month("o_orderdate").alias("month")), ["month"])


@query(
    "numeric_summary", "A5",
    f"""select {sql_round('avg(l_extendedprice)', 6)} as mean, {sql_round('stddev_samp(l_extendedprice)', 6)} as stddev,
    min(l_extendedprice) as min, max(l_extendedprice) as max from lineitem""",
)
def _(spark, sf_dir):
    row = profile.summary(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return row.select(F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"), "min", "max")


@query(
    "frame_shapes", "Q17 A1",
    sql_union(
        [
            f"select '{t}' as frame, (select count(*) from {t}) as row_count, "
            f"(select cast(count(*) as integer) from information_schema.columns where table_name = '{t}') as column_count"
            for t in ["orders", "customer", "part"]
        ]
    ),
)
def _(spark, sf_dir):
    return profile.frame_shapes({t: table(spark, sf_dir, t) for t in ["orders", "customer", "part"]})
