"""Correlations."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_round, sql_union, table
from punctual.operators import assoc, selection, tables

FEATURES = ["quantity", "price", "net", "discount"]
TARGET = "tax"
ALL = [*FEATURES, TARGET]


def frame(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("cluster"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


BASE = """base as (select l_linenumber as cluster, l_quantity as quantity, l_extendedprice as price,
  l_extendedprice * (1 - l_discount) as net, l_discount + 0.0 as discount, l_tax + 0.0 as tax from lineitem)"""


def ranks_sql(by: str = "") -> str:
    """Average ranks of every column, inside groups if asked."""
    part = f"partition by {by} " if by else ""
    tie = f"partition by {by}, " if by else "partition by "
    ranks = ", ".join(
        f"rank() over ({part}order by {c}) + (count(*) over ({tie}{c}) - 1) / 2e0 as {c}" for c in ALL
    )
    return f"ranks as (select cluster, {ranks} from base)"


def _pairs_sql(source: str, columns: list[str], digits: int, ids: str = "") -> str:
    group = f" group by {ids}" if ids else ""
    return sql_union(
        [
            f"select {ids + ', ' if ids else ''}'{a}' as row_feature, '{b}' as column_feature, "
            f"{sql_round(f'corr({a}, {b})', digits)} as correlation from {source}{group}"
            for a in columns for b in columns
        ]
    )


@query("pearson_long", "A16 V7", f"with {BASE} {_pairs_sql('base', ALL, 6)}")
def _(spark, sf_dir):
    return assoc.pearson_long(frame(spark, sf_dir), ALL, digits=6)


@query(
    "pearson_pairwise_nulls", "A16",
    f"""with {BASE}, holed as (select nullif(discount, 0) as discount, nullif(tax, 0) as tax, price from base)
    {_pairs_sql('holed', ['discount', 'tax', 'price'], 6)}""",
)
def _(spark, sf_dir):
    df = frame(spark, sf_dir).select(
        F.nullif("discount", F.lit(0.0)).alias("discount"), F.nullif("tax", F.lit(0.0)).alias("tax"), "price"
    )
    return assoc.pearson_long(df, ["discount", "tax", "price"], digits=6)


@query("pearson_matrix", "A16 N7 S8", f"with {BASE} {_pairs_sql('base', ALL, 6)}")
def _(spark, sf_dir):
    long = assoc.pearson_matrix(frame(spark, sf_dir), ALL)
    return long.withColumn("correlation", F.round("correlation", 6))


@query("spearman_long", "A17 V7", f"with {BASE}, {ranks_sql()} {_pairs_sql('ranks', ALL, 6)}")
def _(spark, sf_dir):
    return assoc.spearman_long(frame(spark, sf_dir), ALL, digits=6)


@query(
    "spearman_by_cluster", "A17 L9",
    f"with {BASE}, {ranks_sql('cluster')} {_pairs_sql('ranks', ALL, 6, 'cluster')}",
)
def _(spark, sf_dir):
    return assoc.spearman_long(frame(spark, sf_dir), ALL, within="cluster", digits=6)


_LONG = f"with {BASE}, {ranks_sql()}, long as ({_pairs_sql('ranks', ALL, 10)})"
_PLACE = "case {f} " + " ".join(f"when '{f}' then {i}" for i, f in enumerate(FEATURES)) + " end"
_HIGH = f"""{_LONG}, high as (select row_feature as first, column_feature as second, correlation as exact from long
  where {_PLACE.format(f='row_feature')} < {_PLACE.format(f='column_feature')} and abs(correlation) > 0.5)"""


@query("high_corr_pairs", "L1 F7", f"{_HIGH} select first, second, {sql_round('exact', 4)} as correlation from high")
def _(spark, sf_dir):
    return assoc.high_pairs(assoc.spearman_long(frame(spark, sf_dir), ALL), FEATURES, threshold=0.5)


@query(
    "corr_prune", "L2 J1",
    f"""{_HIGH}, strength as (select row_feature as f, {sql_round('abs(correlation)', 4)} as s from long
    where column_feature = '{TARGET}')
    select first, second, {sql_round('exact', 4)} as correlation, a.s as first_target, b.s as second_target,
    case when a.s >= b.s then second else first end as dropped
    from high join strength a on a.f = first join strength b on b.f = second""",
)
def _(spark, sf_dir):
    long = assoc.spearman_long(frame(spark, sf_dir), ALL)
    return assoc.prune_pairs(long, FEATURES, TARGET, threshold=0.5)


_RANKING = f"with {BASE}, {ranks_sql('cluster')}, strengths as (" + sql_union(
    [
        f"select cluster, {i} as place, '{f}' as feature, {sql_round(f'corr({f}, {TARGET})', 4)} as correlation "
        "from ranks group by cluster"
        for i, f in enumerate(FEATURES)
    ]
) + """), ranking as (select cluster, feature, correlation,
  cast(row_number() over (partition by cluster order by abs(correlation) desc, place) as integer) as rank from strengths)"""


@query("spearman_rank", "L9 A17 W1", f"{_RANKING} select cluster, feature, correlation, rank from ranking")
def spearman_rank(spark, sf_dir):
    return selection.spearman_ranking(frame(spark, sf_dir), FEATURES, TARGET)


_CLUSTERS = range(1, 8)


def _matrix_sql(value: str, fill: str) -> str:
    return ", ".join(
        f"coalesce(max({value}) filter (where cluster = {c}), {fill}) as cluster_{c}" for c in _CLUSTERS
    )


@query(
    "rank_matrix", "L9 A10 F13",
    f"{_RANKING} select feature, {_matrix_sql('rank', '5')} from ranking where rank <= 3 group by feature",
)
def _(spark, sf_dir):
    ranked = spearman_rank(spark, sf_dir).filter(F.col("rank") <= 3)
    return selection.rank_matrix(ranked, _CLUSTERS, len(FEATURES))


@query(
    "importance_matrix", "L4 A10",
    f"{_RANKING} select feature, "
    + ", ".join(f"max(correlation) filter (where cluster = {c}) as cluster_{c}" for c in _CLUSTERS)
    + " from ranking where rank <= 2 group by feature",
)
def _(spark, sf_dir):
    ranked = spearman_rank(spark, sf_dir).filter(F.col("rank") <= 2)
    return selection.importance_matrix(ranked, _CLUSTERS, "correlation")


@query(
    "coefficient_matrix", "L8 A10 F13",
    f"{_RANKING} select feature, {_matrix_sql('correlation', '0')} from ranking where rank <= 2 group by feature",
)
def _(spark, sf_dir):
    ranked = spearman_rank(spark, sf_dir).filter(F.col("rank") <= 2)
    return selection.coefficient_matrix(ranked.withColumnRenamed("correlation", "coefficient"), _CLUSTERS)


@query(
    "selected_matrix", "L6 A10",
    f"{_RANKING}, marked as (select *, '✓' as mark from ranking where rank <= 2) "
    f"select feature, {_matrix_sql('mark', repr('-'))} from marked group by feature",
)
def _(spark, sf_dir):
    ranked = spearman_rank(spark, sf_dir).filter(F.col("rank") <= 2)
    return selection.selected_matrix(ranked, _CLUSTERS)


_VOTES = f"""{_RANKING}, ballots as (select cluster, feature from ranking where rank <= 2
  union all select cluster, feature from ranking where correlation > 0 union all select cluster, feature from ranking
  where feature in ('price', 'net') union all select cluster, feature from ranking where rank = 1),
votes as (select cluster, feature, count(*) as votes, cast(count(*) >= 2 as integer) as chosen from ballots group by 1, 2)"""


def _votes(spark, sf_dir):
    ranked = spearman_rank(spark, sf_dir)
    return selection.vote(
        {
            "top": ranked.filter(F.col("rank") <= 2), "positive": ranked.filter(F.col("correlation") > 0),
            "named": ranked.filter(F.col("feature").isin("price", "net")), "best": ranked.filter(F.col("rank") == 1),
        }
    )


@query("votes", "L10 U1 A2", f"{_VOTES} select * from votes")
def _(spark, sf_dir):
    return _votes(spark, sf_dir)


@query(
    "vote_matrix", "L10 A10",
    f"{_VOTES}, wide as (select feature, {_matrix_sql('chosen', '0')} from votes group by feature) "
    f"select *, {' + '.join(f'cluster_{c}' for c in _CLUSTERS)} as total from wide",
)
def _(spark, sf_dir):
    return selection.vote_matrix(_votes(spark, sf_dir), _CLUSTERS)


@query(
    "chosen_counts", "L10 O3",
    f"{_VOTES} select feature, count(*) as \"count\" from votes where chosen = 1 group by 1",
)
def _(spark, sf_dir):
    return tables.top_groups(_votes(spark, sf_dir).filter(F.col("chosen") == 1), ["feature"])
