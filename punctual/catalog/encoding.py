"""Encoders, scalers and category documents."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_hash, sql_round, sql_union, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL
from punctual.functions import HASH_SPACE, prefixed, stable_hash, unprefixed
from punctual.operators import encode

_PRIORITIES = range(5)
_INDEXED = """indexed as (select o_orderpriority, row_number() over (order by count(*) desc, o_orderpriority) - 1 as slot
  from orders group by 1)"""


@query(
    "string_index", "N1",
    f"with {_INDEXED} select o_orderkey, cast(slot as double) as o_orderpriority_index from orders join indexed using (o_orderpriority)",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encode.fit_one_hot(orders, ["o_orderpriority"]).transform(orders).select("o_orderkey", "o_orderpriority_index")


@query(
    "onehot", "N2 P15 P16 P14 M11",
    f"with {_INDEXED} select o_orderkey, "
    + ", ".join(f"cast(slot = {i} as integer)::double as priority_{i}" for i in _PRIORITIES)
    + " from orders join indexed using (o_orderpriority)",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    encoded = encode.fit_one_hot(orders, ["o_orderpriority"]).transform(orders)
    names = [f"priority_{i}" for i in range(encode.slot_count(encoded, "o_orderpriority_vec"))]
    return encode.vector_columns(encoded, "o_orderpriority_vec", names).select("o_orderkey", *names)


@query(
    "onehot_slots", "P16 N1",
    f"with {_INDEXED} select cast(slot as integer) as slot, o_orderpriority as name from indexed",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    encoded = encode.fit_one_hot(orders, ["o_orderpriority"]).transform(orders)
    rows = list(enumerate(encode.slot_names(encoded, "o_orderpriority_vec")))
    return spark.createDataFrame(rows, "slot int, name string")


@query(
    "onehot_unseen", "N1 N2",
    """select p_partkey, cast(0 as double) as seen_slots from part""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("o_orderpriority"))
    encoded = encode.fit_one_hot(orders, ["o_orderpriority"]).transform(parts)
    names = [f"s{i}" for i in _PRIORITIES]
    wide = encode.vector_columns(encoded, "o_orderpriority_vec", names)
    return wide.select("p_partkey", sum((F.col(n) for n in names), F.lit(0.0)).alias("seen_slots"))


# Training lines are those whose key hash falls below 70 %; an order is unseen if none of its lines does.
_SHARE = 0.7
_SPLIT = f"""lines as (select {LINE_KEY_SQL}, {sql_hash(*LINE_KEY)} < cast(floor({_SHARE} * {HASH_SPACE}) as bigint) as train
  from lineitem), freq as (select l_orderkey, {sql_round('count(*) * 1e0 / (select count(*) from lines where train)', 6)}
  as l_orderkey_freq from lines where train group by 1)"""


def _split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    in_train = stable_hash(*LINE_KEY) < int(_SHARE * HASH_SPACE)
    return lines.filter(in_train), lines.filter(~in_train)


@query("freq_table", "N3 A2", f"with {_SPLIT} select l_orderkey, l_orderkey_freq from freq")
def _(spark, sf_dir):
    return encode.frequency_table(_split(spark, sf_dir)[0], "l_orderkey")


@query("freq_encode", "N3 J4", f"with {_SPLIT} select {LINE_KEY_SQL}, l_orderkey_freq from lines join freq using (l_orderkey) where train")
def _(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return encode.apply_frequencies(train, encode.fit_frequencies(train, ["l_orderkey"])["l_orderkey"])


@query(
    "freq_unseen_fill", "N4 F12 J4",
    f"""with {_SPLIT} select {LINE_KEY_SQL}, coalesce(l_orderkey_freq, (select quantile_disc(l_orderkey_freq, 0.5) from freq))
    as l_orderkey_freq from lines left join freq using (l_orderkey) where not train""",
)
def _(spark, sf_dir):
    train, held = _split(spark, sf_dir)
    return encode.apply_frequencies(held, encode.fit_frequencies(train, ["l_orderkey"])["l_orderkey"])


@query(
    "freq_medians", "N5",
    f"""with {_SPLIT} select 'l_orderkey_freq' as "column", quantile_disc(l_orderkey_freq, 0.5) as median
    from lines join freq using (l_orderkey) where train""",
)
def _(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    encoded = encode.apply_frequencies(train, encode.frequency_table(train, "l_orderkey"), "l_orderkey")
    return encode.row_medians(encoded, ["l_orderkey_freq"])


@query(
    "unseen_report", "N6 J5 A15 O3",
    f"""with {_SPLIT} select l_orderkey, count(*) as "count",
    {sql_round('count(*) * 1e0 / (select count(*) from lines where not train)', 6)} as frequency
    from lines where not train and l_orderkey not in (select l_orderkey from lines where train)
    group by 1 order by 2 desc, 1 limit 5""",
)
def _(spark, sf_dir):
    train, held = _split(spark, sf_dir)
    return encode.unseen_values(held, train, "l_orderkey")


_SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "standard_scale", "N7 N8 P15 P14",
    f"select {LINE_KEY_SQL}, "
    + ", ".join(
        sql_round(f"({c} - (select avg({c}) from lineitem)) / (select stddev_samp({c}) from lineitem)", 6) + f" as {c}_scaled"
        for c in _SCALED
    )
    + " from lineitem",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *_SCALED)
    scaled = encode.scaled_columns(lines, encode.fit_scaler(lines, _SCALED), _SCALED)
    return scaled.select(*LINE_KEY, *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _SCALED])


@query(
    "cast_stage", "P8 M11",
    "select o_orderkey, cast(o_custkey as double) as o_custkey_double from orders",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return encode.cast_stage(["o_custkey"]).transform(orders).drop("o_custkey")


_DOC = "'o_orderstatus_' || o_orderstatus || ' o_orderpriority_' || o_orderpriority"


def _documents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return encode.category_document(orders, ["o_orderstatus", "o_orderpriority"])


@query("category_doc", "N9 C9 P11", f"select o_orderkey, {_DOC} as category_doc from orders")
def _(spark, sf_dir):
    return _documents(spark, sf_dir).select("o_orderkey", "category_doc")


@query(
    "tokens", "N10 C12",
    f"""select o_orderkey, replace(lower({_DOC}), ' ', '|') as tokens,
    cast(len(string_split({_DOC}, ' ')) as integer) as token_count from orders""",
)
def _(spark, sf_dir):
    tokens = encode.tokenise(_documents(spark, sf_dir))
    return tokens.select("o_orderkey", F.array_join("tokens", "|").alias("tokens"), F.size("tokens").alias("token_count"))


@query(
    "prefix_undo", "N12 C10",
    sql_union(
        [
            "select o_orderkey, regexp_extract('o_orderpriority_' || o_orderpriority, '_([^_]+)$', 1) as value from orders",
            "select -1 - n_nationkey, regexp_extract('n_name_' || n_name, '_([^_]+)$', 1) from nation",
        ]
    ),
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", unprefixed(prefixed("o_orderpriority")).alias("value"))
    nations = table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey")).cast("long").alias("o_orderkey"), unprefixed(prefixed("n_name")).alias("value")
    )
    return orders.unionByName(nations)


@query(
    "value_shares", "A15 A2",
    f"""select p_brand, count(*) as "count", {sql_round('count(*) * 100e0 / (select count(*) from part)', 2)} as percentage
    from part group by 1""",
)
def _(spark, sf_dir):
    return encode.share_table(table(spark, sf_dir, "part"), "p_brand")
