"""Samples, splits and indexes."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_hash, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL
from punctual.operators import codes, features, keys, profile

_HASH = sql_hash(*LINE_KEY)
_SHOWN = ", ".join([*LINE_KEY, "l_quantity"])


@query("stable_sample", "T1 F15 P13", f"select {_SHOWN} from lineitem where {_HASH} < cast(floor(0.05 * 4294967296) as bigint)")
def _(spark, sf_dir):
    return keys.stable_sample(table(spark, sf_dir, "lineitem"), LINE_KEY, 0.05).select(*LINE_KEY, "l_quantity")


@query(
    "stable_limit", "O4 V5 T1 F11",
    f"select {_SHOWN} from lineitem where l_quantity is not null order by {_HASH}, {LINE_KEY_SQL} limit 10000",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity").dropna(subset=["l_quantity"])
    return keys.stable_limit(df, LINE_KEY, 10_000)


_MONTHS = f"""months as (select {LINE_KEY_SQL}, cast(month(l_shipdate) as integer) as month, {_HASH} as h from lineitem),
ranked as (select *, row_number() over (partition by month order by h, {LINE_KEY_SQL}) as rn,
  count(*) over (partition by month) as n from months)"""
_LABEL = "case when rn * 100 <= n * 70 then 'train' when rn * 100 <= n * 85 then 'val' else 'test' end"


def _months(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, F.month("l_shipdate").alias("month"))


@query("rank_in_stratum", "W1 W2", f"with {_MONTHS} select {LINE_KEY_SQL}, month, cast(rn as integer) as rn, n from ranked")
def _(spark, sf_dir):
    # The hash is a column: as an expression of the order every comparison of two rows would make it again.
    df = _months(spark, sf_dir).withColumn("_hash", keys.stable_hash(*LINE_KEY))
    ranked = keys.rank_in_stratum(df, ["month"], ["_hash", *LINE_KEY], "rn", "n").drop("_hash")
    return ranked.withColumn("rn", F.col("rn").cast("int"))


@query("stratified_split", "W1 W2 C7 F16", f"with {_MONTHS} select {LINE_KEY_SQL}, month, {_LABEL} as split from ranked")
def _(spark, sf_dir):
    return keys.stratified_split(_months(spark, sf_dir), "month", LINE_KEY)


@query(
    "split_sizes", "W1 Q10 F16 A2",
    f"""with {_MONTHS}, labelled as (select month, {_LABEL} as split from ranked)
    select split, month, count(*) as "count",
    cast(round(cast(count(*) * 100e0 / sum(count(*)) over (partition by split) as decimal(30,12)), 2) as double) as percentage
    from labelled group by split, month""",
)
def _(spark, sf_dir):
    split = keys.stratified_split(_months(spark, sf_dir), "month", LINE_KEY)
    return profile.stratum_share(split, ["month"], within=["split"])


_ORDER = ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]


@query(
    "global_index", "W3 P1 O1",
    f"select row_number() over (order by {', '.join(_ORDER)}) as index, {LINE_KEY_SQL} from lineitem",
)
def _(spark, sf_dir):
    return keys.global_index(table(spark, sf_dir, "lineitem").select(*LINE_KEY), _ORDER)


@query(
    "index_unique", "Q12 A7",
    "select count(*) as rows, count(*) as distinct_index, true as is_unique from lineitem",
)
def _(spark, sf_dir):
    indexed = keys.global_index(table(spark, sf_dir, "lineitem").select(*LINE_KEY), _ORDER)
    return profile.index_uniqueness(indexed, "index")


@query(
    "index_first", "P1 P2",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return features.index_first(df.select(*reversed(df.columns)), "o_orderkey")


@query("partition_unique_id", "P12", "select count(*) as rows, count(*) as distinct_ids from orders")
def _(spark, sf_dir):
    tagged = keys.partition_unique_id(table(spark, sf_dir, "orders").select("o_orderkey"))
    return tagged.groupBy("index").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("rows"), F.count("index").alias("distinct_ids")
    )


@query(
    "semi_rows_of_dup_keys", "J6",
    f"""select {_SHOWN} from lineitem where (l_orderkey, l_linenumber) in
    (select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity")
    return codes.rows_of_duplicate_keys(df, ["l_orderkey", "l_linenumber"])
