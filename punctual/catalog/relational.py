"""Ranked tables, means and plain relational rows."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_round, sql_union, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, movements
from punctual.functions import route
from punctual.operators import features, heavy, tables
from punctual.plans.explore import filter_complete, overview


def _nation_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )


@query(
    "top_groups", "O3 V1 A2 J1",
    """select n_name, count(*) as "count" from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    group by n_name order by 2 desc, 1 limit 10""",
)
def top_groups(spark, sf_dir):
    return tables.top_groups(_nation_lines(spark, sf_dir), ["n_name"], 10)


@query(
    "top_routes", "O3 V4 E5 C9",
    f"""{MOVEMENTS} select ORIGIN_AIRPORT || '_' || DESTINATION_AIRPORT as ROUTE, count(*) as "count" from movements
    group by 1 order by 2 desc, 1 limit 10""",
)
def _(spark, sf_dir):
    return overview(movements(spark, sf_dir))["top_routes"]


@query(
    "heavy_parts", "O3 A2",
    """select l_partkey, count(*) as "count" from lineitem group by l_partkey order by 2 desc, 1 limit 20""",
)
def _(spark, sf_dir):
    return heavy.top_values(table(spark, sf_dir, "lineitem"), ["l_partkey"], 20)


@query(
    "heavy_pairs", "O3 O5 A2",
    f"""{MOVEMENTS} select ORIGIN_AIRPORT, DESTINATION_AIRPORT, count(*) as "count" from movements
    group by 1, 2 order by 3 desc, 1, 2 limit 25""",
)
def _(spark, sf_dir):
    return heavy.top_values(movements(spark, sf_dir), ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"], 25)


@query(
    "worst_routes", "O3 V4 A3 E5",
    f"""{MOVEMENTS} select ROUTE, "count", {sql_round('mean', 6)} as avg_delay from (
    select ORIGIN_AIRPORT || ' → ' || DESTINATION_AIRPORT as ROUTE, count(*) as "count", avg(ARRIVAL_DELAY) as mean
    from movements group by 1 order by 3 desc, 1 limit 15)""",
)
def _(spark, sf_dir):
    routed = features.with_route(movements(spark, sf_dir), "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE", " → ")
    top = tables.top_groups(routed, ["ROUTE"], 15, {"mean": F.avg("ARRIVAL_DELAY")}, order="mean")
    return top.select("ROUTE", "count", F.round("mean", 6).alias("avg_delay"))


@query(
    "group_means", "A3 A4 V2 P6",
    f"""{MOVEMENTS} select AIRLINE, {sql_round('avg(ARRIVAL_DELAY)', 6)} as avg_ARRIVAL_DELAY,
    {sql_round('avg(DEPARTURE_DELAY)', 6)} as avg_DEPARTURE_DELAY from movements group by 1""",
)
def _(spark, sf_dir):
    return tables.group_means(movements(spark, sf_dir), ["AIRLINE"], ["ARRIVAL_DELAY", "DEPARTURE_DELAY"], digits=6)


@query(
    "hourly_mean", "A3 V3 E9 C3",
    f"""{MOVEMENTS} select cast(SCHEDULED_DEPARTURE // 100 as bigint) as hour,
    {sql_round('avg(DEPARTURE_DELAY)', 6)} as avg_DEPARTURE_DELAY from movements group by 1""",
)
def _(spark, sf_dir):
    timed = features.with_hour(movements(spark, sf_dir), "SCHEDULED_DEPARTURE")
    return tables.group_means(timed, ["hour"], ["DEPARTURE_DELAY"], digits=6)


@query("category_distribution", "V6 A2", """select o_orderpriority, count(*) as "count" from orders group by 1""")
def _(spark, sf_dir):
    return tables.category_distribution(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "complete_rows", "F1 F11",
    f"""{MOVEMENTS} select {LINE_KEY_SQL}, LATE_AIRCRAFT_DELAY, WEATHER_DELAY from movements
    where AIR_SYSTEM_DELAY is not null and SECURITY_DELAY is not null and AIRLINE_DELAY is not null
    and LATE_AIRCRAFT_DELAY is not null and WEATHER_DELAY is not null""",
)
def _(spark, sf_dir):
    return filter_complete(movements(spark, sf_dir)).select(*LINE_KEY, "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY")


@query(
    "spot_check", "F2 F5",
    f"""{MOVEMENTS} select {LINE_KEY_SQL}, ORIGIN_AIRPORT from movements
    where FLIGHT_NUMBER = 20 and MONTH in (10) and DAY = 1""",
)
def _(spark, sf_dir):
    df = movements(spark, sf_dir)
    wanted = (F.col("FLIGHT_NUMBER") == 20) & F.col("MONTH").isin(10) & (F.col("DAY") == 1)
    return df.filter(wanted).select(*LINE_KEY, "ORIGIN_AIRPORT")


@query(
    "computed_columns", "P3 P4 P5 P6 P7 P11 C1 C2 C4 C5 C8 C11 C13",
    """select o_orderkey as order_id, round(o_totalprice) as price, cast(o_custkey as varchar) as customer,
    cast(o_custkey % 7 as bigint) as remainder, abs(o_custkey - 500) as distance, 'orders' as source,
    cast(o_totalprice > 200000 as integer) as large from orders""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumns(
        {
            "price": F.round("o_totalprice", 0), "customer": F.col("o_custkey").cast("string"),
            "remainder": F.col("o_custkey") % 7, "distance": F.expr("abs(o_custkey - 500)"), "source": F.lit("orders"),
            "large": (F.col("o_totalprice") > 200_000).cast("int"),
        }
    )
    df = df.drop("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return df.withColumnsRenamed({"o_orderkey": "order_id"})


@query(
    "union_codes", "U1 U2 A12",
    "select n_regionkey as code from nation union select r_regionkey from region union select c_nationkey from customer",
)
def _(spark, sf_dir):
    codes = [("nation", "n_regionkey"), ("region", "r_regionkey"), ("customer", "c_nationkey")]
    parts = [table(spark, sf_dir, t).select(F.col(c).alias("code")) for t, c in codes]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query(
    "union_all_codes", "U1",
    sql_union(["select s_nationkey as code, 's' as side from supplier", "select c_nationkey, 'c' from customer"]),
)
def _(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("code"), F.lit("s").alias("side"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("code"), F.lit("c").alias("side"))
    return supplier.unionByName(customer)


@query(
    "ordered_top", "O1 O2 S7",
    """select c_custkey, c_nationkey, c_acctbal from customer order by abs(c_acctbal) desc, c_custkey limit 100""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return df.orderBy(F.abs("c_acctbal").desc(), "c_custkey").limit(100)


@query(
    "pivot_first", "A10 F12 F13",
    """select o_orderpriority, coalesce(max(n) filter (where o_orderstatus = 'F'), 0) as status_F,
    coalesce(max(n) filter (where o_orderstatus = 'O'), 0) as status_O,
    coalesce(max(n) filter (where o_orderstatus = 'P'), 0) as status_P,
    coalesce(max(n) filter (where o_orderstatus = 'X'), 0) as status_X
    from (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2) group by 1""",
)
def _(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return tables.pivot_first(
        counts, "o_orderpriority", "o_orderstatus", "n", ["F", "O", "P", "X"], fill=F.lit(0), prefix="status_"
    )


@query(
    "array_elements", "P14 F6",
    """select vec_id, embedding[1] as first, embedding[2] as second, label from embeddings
    where embedding[1] > -0.1 and embedding[1] < 0.1 and embedding[2] > -0.1 and embedding[2] < 0.1""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    first, second = F.col("embedding")[0], F.col("embedding")[1]
    boxed = df.filter((first > -0.1) & (first < 0.1) & (second > -0.1) & (second < 0.1))
    return boxed.select("vec_id", first.alias("first"), second.alias("second"), "label")


@query(
    "routes_of_lines", "J3 E5 P10",
    """select distinct f.n_name as start_name, t.n_name as end_name, f.n_name || '_' || t.n_name as route
    from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
    join customer on o_custkey = c_custkey join nation f on f.n_nationkey = s_nationkey
    join nation t on t.n_nationkey = c_nationkey""",
)
def _(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("s_nationkey", "c_nationkey").distinct()
    )
    return (
        lines.join(nation.selectExpr("n_nationkey as s_nationkey", "n_name as start_name"), "s_nationkey", "left")
        .join(nation.selectExpr("n_nationkey as c_nationkey", "n_name as end_name"), "c_nationkey", "left")
        .select("start_name", "end_name", route("start_name", "end_name").alias("route")).distinct()
    )
