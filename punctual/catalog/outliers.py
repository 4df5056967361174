"""Quantiles, caps and box plots."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_percent, sql_round, sql_union, table
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, movements
from punctual.operators import outliers, sketches
from punctual.operators.quantiles import quantiles
from punctual.staging import stage

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "exact_quantiles", "A13",
    sql_union(
        [
            f"select '{c}' as \"column\", {p}::double as p, quantile_disc({c}, {p}) + 0.0 as value from lineitem"
            for c in _COLUMNS for p in (0.1, 0.5, 0.975)
        ]
    ),
)
def _(spark, sf_dir):
    found = quantiles(table(spark, sf_dir, "lineitem"), {c: [0.1, 0.5, 0.975] for c in _COLUMNS})
    rows = [(c, p, v + 0.0) for (c, p), v in found.items()]
    return spark.createDataFrame(rows, "column string, p double, value double")


@query("approx_quantiles", "A13")
def _(spark, sf_dir):
    found = quantiles(table(spark, sf_dir, "lineitem"), {c: [0.25, 0.5, 0.75] for c in _COLUMNS}, relative_error=0.01)
    return spark.createDataFrame([(c, p, v) for (c, p), v in found.items()], "column string, p double, value double")


# Sketches by line number are merged; the twin holds that every answer's rank is near the one asked for.
@query(
    "sketch_quantiles", "A13",
    "select l_returnflag, \"column\", p, count(*) as rows, true as near from lineitem, "
    f"(select unnest({_COLUMNS}) as \"column\"), (select unnest([0.01, 0.25, 0.5, 0.9, 0.99]::double[]) as p) group by all",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", *_COLUMNS)
    fine = stage(sketches.quantile_sketches(df, _COLUMNS, ["l_returnflag", "l_linenumber"]), "sketches")
    answers = sketches.sketched_quantiles(sketches.merged(fine, ["l_returnflag"]), [0.01, 0.25, 0.5, 0.9, 0.99], ["l_returnflag"])
    errors = sketches.rank_errors(df, answers, _COLUMNS, ["l_returnflag"])
    return errors.select("l_returnflag", "column", "p", "rows", (F.col("error") <= sketches.RANK_ERROR).alias("near"))


@query(
    "quantile_interp", "A14",
    sql_union(
        [f"select '{c}' as \"column\", {sql_round(f'quantile_cont({c}, 0.9)', 6)} as p90 from lineitem" for c in _COLUMNS]
    ),
)
def _(spark, sf_dir):
    found = quantiles(table(spark, sf_dir, "lineitem"), {c: [0.9] for c in _COLUMNS}, interpolate=True)
    rows = [(c, v) for (c, _), v in found.items()]
    return spark.createDataFrame(rows, "column string, v double").select("column", F.round("v", 6).alias("p90"))


@query(
    "cap_quantile", "D6 C7",
    f"""select {LINE_KEY_SQL}, least(l_extendedprice, (select quantile_disc(l_extendedprice, 0.975) from lineitem))
    as l_extendedprice from lineitem""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return outliers.cap_at_quantile(df, "l_extendedprice", 0.975)


@query(
    "cap_fitted_elsewhere", "D6 F7",
    """select o_orderkey, least(o_totalprice, (select quantile_disc(l_extendedprice, 0.99) from lineitem))
    as o_totalprice from orders""",
)
def _(spark, sf_dir):
    threshold = outliers.fit_cap(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.99)
    return outliers.cap_above(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", threshold)


def _q(p: float) -> str:
    return f"quantile_disc(l_extendedprice, {p})"


@query(
    "quartile_report", "D7 A13 F7",
    f"""with q as (select {_q(.25)} as q1, {_q(.5)} as median, {_q(.75)} as q3, {_q(.95)} as p95, {_q(.975)} as p975,
    {_q(.99)} as p99 from lineitem)
    select q1, median, q3, {sql_round('q3 - q1', 6)} as iqr, p95, p975, p99,
    (select {sql_percent('count(*) filter (where l_extendedprice > p95)', 'count(*)')} from lineitem) as above_p95_percent,
    (select {sql_percent('count(*) filter (where l_extendedprice > p975)', 'count(*)')} from lineitem) as above_p975_percent
    from q""",
)
def _(spark, sf_dir):
    return outliers.quartile_report(table(spark, sf_dir, "lineitem"), "l_extendedprice")


_BOXED = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"]


def _box_sql(c: str) -> str:
    return f"""select '{c}' as "column", q1 + 0.0 as q1, median + 0.0 as median, q3 + 0.0 as q3,
    (select min({c})::double + 0.0 from lineitem where {c} between q1 - 1.5e0 * (q3 - q1) and q3 + 1.5e0 * (q3 - q1)) as whisker_low,
    (select max({c})::double + 0.0 from lineitem where {c} between q1 - 1.5e0 * (q3 - q1) and q3 + 1.5e0 * (q3 - q1)) as whisker_high,
    (select count(*) from lineitem where {c} not between q1 - 1.5e0 * (q3 - q1) and q3 + 1.5e0 * (q3 - q1)) as outliers
    from (select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.5) as median,
      quantile_cont({c}::double, 0.75) as q3 from lineitem)"""


@query("box_stats", "D8 A14", sql_union([_box_sql(c) for c in _BOXED]))
def _(spark, sf_dir):
    stats = outliers.box_stats(table(spark, sf_dir, "lineitem"), _BOXED)
    # Adding 0 turns the negative zeros of the tax column into plain ones.
    return stats.select("column", *[(F.col(c) + 0.0).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]], "outliers")


@query(
    "floor_filter", "D9 F7",
    f"{MOVEMENTS} select {LINE_KEY_SQL}, DEPARTURE_DELAY from movements where DEPARTURE_DELAY >= -10",
)
def _(spark, sf_dir):
    return outliers.filter_min(movements(spark, sf_dir), "DEPARTURE_DELAY", -10).select(*LINE_KEY, "DEPARTURE_DELAY")
