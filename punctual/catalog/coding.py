"""Code repair."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_union, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, fanout_pairs, movements, place_pairs
from punctual.operators import codes
from punctual.plans.columns import PLACES

# Movements keep the names known for codes below 20 only, so that some codes stay numeric.
_PAIRS = "pairs as (select cast(n_nationkey as varchar) as code, n_name as label from nation where n_nationkey < 20)"
_CLEAN = f""", {_PAIRS}, cleaned as (select m.*, coalesce(a.label, ORIGIN_AIRPORT) as ORIGIN_AIRPORT_clean,
  coalesce(b.label, DESTINATION_AIRPORT) as DESTINATION_AIRPORT_clean from movements m
  left join pairs a on a.code = ORIGIN_AIRPORT left join pairs b on b.code = DESTINATION_AIRPORT)"""


def _cleaned(spark, sf_dir):
    known = place_pairs(spark, sf_dir).filter(F.col("code").cast("int") < 20)
    return codes.replace_codes(movements(spark, sf_dir), PLACES, known)


@query(
    "code_map", "D1 J1 P5 P7",
    """select distinct cast(n_nationkey as varchar) as code, s_name as label from nation
    join (select s_name, n_name from supplier join nation on n_nationkey = s_nationkey) using (n_name)""",
)
def _(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "description")
    ids = nation.select("n_nationkey", "description")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    labels = supplier.join(nation, "n_nationkey").select("s_name", "description")
    return codes.build_code_map(ids, labels, "description", "n_nationkey", "s_name")


@query(
    "codes_in_use", "D2 F4 U1 U2",
    f"""{MOVEMENTS} select code from (select ORIGIN_AIRPORT as code from movements union
    select DESTINATION_AIRPORT from movements) where regexp_matches(code, '^[0-9]+')""",
)
def _(spark, sf_dir):
    return codes.codes_in_use(movements(spark, sf_dir), PLACES)


@query(
    "replace_codes", "D2 J2 J3",
    f"""{MOVEMENTS}{_CLEAN} select {LINE_KEY_SQL}, ORIGIN_AIRPORT, DESTINATION_AIRPORT, ORIGIN_AIRPORT_clean,
    DESTINATION_AIRPORT_clean from cleaned""",
)
def _(spark, sf_dir):
    return _cleaned(spark, sf_dir).select(*LINE_KEY, *PLACES, *[f"{c}_clean" for c in PLACES])


@query(
    "residual_codes", "D3 F4",
    f"{MOVEMENTS}{_CLEAN} " + sql_union(
        [
            f"select '{c}_clean' as \"column\", count(*) filter (where regexp_matches({c}_clean, '^[0-9]+')) as residual "
            "from cleaned"
            for c in PLACES
        ]
    ),
)
def _(spark, sf_dir):
    return codes.residual_codes(_cleaned(spark, sf_dir), [f"{c}_clean" for c in PLACES])


@query(
    "changed_codes", "D4 F3 A12",
    f"""{MOVEMENTS}{_CLEAN} select distinct ORIGIN_AIRPORT, ORIGIN_AIRPORT_clean, DESTINATION_AIRPORT,
    DESTINATION_AIRPORT_clean from cleaned
    where ORIGIN_AIRPORT <> ORIGIN_AIRPORT_clean or DESTINATION_AIRPORT <> DESTINATION_AIRPORT_clean""",
)
def _(spark, sf_dir):
    return codes.changed_codes(_cleaned(spark, sf_dir), PLACES)


_FAN = """coded as (select l_orderkey, l_linenumber, l_suppkey, l_partkey, cast(p_size as varchar) as size_code
  from lineitem join part on l_partkey = p_partkey),
fan as (select distinct cast(p_size as varchar) as code, p_brand as label from part)"""


def _coded(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("size_code"))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


@query("preferred_labels", "D5 A8", f"with {_FAN} select code, min(label) as label from fan group by 1")
def _(spark, sf_dir):
    return codes.preferred_labels(fanout_pairs(spark, sf_dir))


@query(
    "fanned_out_keys", "J2 Q12 A9",
    f"""with {_FAN} select size_code, count(*) as "count" from coded left join fan on code = size_code group by 1""",
)
def _(spark, sf_dir):
    fanned = codes.replace_codes(_coded(spark, sf_dir), ["size_code"], fanout_pairs(spark, sf_dir), resolve=False)
    return fanned.groupBy("size_code").agg(F.count(F.lit(1)).alias("count"))


@query(
    "resolve_fanout", "D5 A8 F9",
    f"""with {_FAN}, best as (select code, min(label) as label from fan group by 1)
    select {LINE_KEY_SQL}, size_code, label as size_code_clean from coded join best on code = size_code""",
)
def _(spark, sf_dir):
    fanned = codes.replace_codes(_coded(spark, sf_dir), ["size_code"], fanout_pairs(spark, sf_dir), resolve=False)
    return codes.resolve_fanout(fanned, ["size_code"])


@query(
    "resolved_map", "D5 D2 A8",
    f"""with {_FAN}, best as (select code, min(label) as label from fan group by 1)
    select {LINE_KEY_SQL}, size_code, label as size_code_clean from coded join best on code = size_code""",
)
def _(spark, sf_dir):
    return codes.replace_codes(_coded(spark, sf_dir), ["size_code"], fanout_pairs(spark, sf_dir))
