"""Sources, sinks and schemas."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, table
from punctual.operators import profile
from punctual.sources import CLUSTER_MAP, read_csv, read_csv_header_only, read_table, result_rows, write_csv, write_table
from punctual.staging import stage_path


@query("csv_roundtrip", "S1 S4", "select n_nationkey, n_name, n_regionkey from nation")
def _(spark, sf_dir):
    path = stage_path(spark, "csv")
    nation = table(spark, sf_dir, "nation")
    write_csv(nation, path)
    return read_csv(spark, path, nation.schema)


@query(
    "csv_quoted_text", "S1 S4",
    "select c_custkey, c_name || ', \"' || c_mktsegment || '\"' || chr(10) || c_nationkey as note from customer",
)
def _(spark, sf_dir):
    path = stage_path(spark, "csv")
    note = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\n'), F.col("c_nationkey").cast("string"))
    quoted = table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"))
    write_csv(quoted, path)
    return read_csv(spark, path, quoted.schema, multi_line=True)


@query(
    "cluster_map_csv", "S2 J4",
    "select cast(o_orderkey as integer) as index, cast(o_custkey % 6 as integer) as cluster from orders",
)
def _(spark, sf_dir):
    path = stage_path(spark, "map")
    labels = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("index"), (F.col("o_custkey") % 6).alias("cluster")
    )
    write_csv(labels, path)
    return read_csv_header_only(spark, path, CLUSTER_MAP)


@query("table_roundtrip", "S3 S5", "select * from customer")
def _(spark, sf_dir):
    path = stage_path(spark, "table")
    write_table(table(spark, sf_dir, "region"), path)
    write_table(table(spark, sf_dir, "customer"), path)  # replaces rows and schema
    return read_table(spark, path)


@query(
    "result_rows", "S6 S8",
    """select o_orderstatus as name, count(*) as orders from orders group by 1""",
)
def _(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_orderstatus").count()
    return result_rows(spark, [(r[0], r[1]) for r in counts.collect()], "name string, orders bigint")


_DTYPE = """case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'VARCHAR' then 'string'
  when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>' end"""


@query(
    "schema_table", "S9",
    f"""select cast(ordinal_position as integer) as position, column_name as "column", {_DTYPE} as dtype
    from information_schema.columns where table_name = 'orders'""",
)
def _(spark, sf_dir):
    return profile.schema_table(table(spark, sf_dir, "orders"))


@query(
    "schema_parity", "Q11 S9",
    f"""select column_name as "column", {_DTYPE} as dtype, cast(count(*) as integer) as frames, count(*) = 2 as in_all
    from information_schema.columns where table_name in ('documents', 'labels') group by 1, 2""",
)
def _(spark, sf_dir):
    return profile.schema_parity({t: table(spark, sf_dir, t) for t in ["documents", "labels"]})
