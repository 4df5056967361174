"""Clustering and cluster profiles."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_percent, sql_round, sql_union, table
from punctual.catalog.features import PERIOD_SQL
from punctual.catalog.frames import MOVEMENTS, movements
from punctual.functions import day_period
from punctual.operators import cluster, embedding, encode, kmeans
from punctual.staging import stage

# Exact profiles take the line number as label; places come from the movements.
_NUMBERS = ["DEPARTURE_DELAY", "DISTANCE", "AIR_TIME"]
_LABELLED = f"""{MOVEMENTS}, labelled as (select *, l_linenumber as cluster,
  {PERIOD_SQL.format(c='SCHEDULED_DEPARTURE')} as period from movements)"""


def _labelled(spark, sf_dir):
    return movements(spark, sf_dir).withColumns(
        {"cluster": F.col("l_linenumber"), "period": day_period("SCHEDULED_DEPARTURE")}
    )


# Places get coordinates from the nation number; some have none, and some lie outside the map.
_PLACES = """places as (select n_name as name, case when n_nationkey % 9 <> 4 then 18 + n_nationkey * 1.5e0 end as lat,
  -135 + n_nationkey * 3.5e0 as lon from nation)"""


def _places(spark, sf_dir):
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.when(key % 9 != 4, 18 + key * F.lit(1.5)).alias("lat"),
        (-135 + key * F.lit(3.5)).alias("lon"),
    )


@query("cluster_sizes", "K5 A2", f"""{_LABELLED} select cluster, count(*) as "count" from labelled group by 1""")
def _(spark, sf_dir):
    return cluster.cluster_sizes(_labelled(spark, sf_dir))


@query(
    "cluster_means", "K6 A3",
    f"{_LABELLED} select cluster, {', '.join(sql_round(f'avg({c})', 6) + f' as avg_{c}' for c in _NUMBERS)} from labelled group by 1",
)
def _(spark, sf_dir):
    return cluster.cluster_means(_labelled(spark, sf_dir), _NUMBERS)


_TOP = """tops as (select ORIGIN_AIRPORT from labelled group by 1 order by count(*) desc, 1 limit 12),
kept as (select cluster, ORIGIN_AIRPORT, count(*) as "count" from labelled
  where ORIGIN_AIRPORT in (select ORIGIN_AIRPORT from tops) group by 1, 2)"""


@query("cluster_topn", "K7 O5", f"{_LABELLED}, {_TOP} select * from kept")
def _(spark, sf_dir):
    return cluster.cluster_counts(_labelled(spark, sf_dir), "ORIGIN_AIRPORT", 12)


@query(
    "cluster_share", "K8 A11 O5",
    f"""{_LABELLED}, {_TOP} select *, cast(round(cast("count" * 1e0 / sum("count") over (partition by cluster)
    as decimal(30,12)), 6) as double) as share from kept""",
)
def _(spark, sf_dir):
    return cluster.cluster_composition(_labelled(spark, sf_dir), "ORIGIN_AIRPORT", 12)


_SHARES = """shares as (select cluster, {c}, count(*) as "count",
  cast(round(cast(count(*) * 100e0 / sum(count(*)) over (partition by cluster) as decimal(30,12)), 2) as double) as percentage
  from labelled group by cluster, {c})"""


@query(
    "cluster_period_share", "K9 A15",
    f"{_LABELLED}, {_SHARES.format(c='period')} select cluster, period, \"count\", percentage from shares",
)
def _(spark, sf_dir):
    return cluster.cluster_value_share(_labelled(spark, sf_dir), "period")


@query(
    "cluster_top10", "K10 W4 A15",
    f"""{_LABELLED}, {_SHARES.format(c='DESTINATION_AIRPORT')}, ranked as (select *,
    cast(row_number() over (partition by cluster order by "count" desc, DESTINATION_AIRPORT) as integer) as rank from shares)
    select cluster, DESTINATION_AIRPORT, "count", percentage, rank from ranked where rank <= 10""",
)
def _(spark, sf_dir):
    return cluster.cluster_top_values(_labelled(spark, sf_dir), "DESTINATION_AIRPORT")


def _dominant(keys: str) -> str:
    return f"""best as (select * exclude (place) from (select {keys}, cluster, count(*) as "count",
      row_number() over (partition by {keys} order by count(*) desc, cluster) as place from labelled group by {keys}, cluster)
      where place = 1)"""


@query(
    "dominant_by_key", "K11 W4 J7 V8",
    f"""{_LABELLED}, {_PLACES}, {_dominant('ORIGIN_AIRPORT')} select distinct ORIGIN_AIRPORT as code, cluster,
    lat as latitude, lon as longitude from best left join places on name = ORIGIN_AIRPORT""",
)
def _(spark, sf_dir):
    best = cluster.dominant_cluster(_labelled(spark, sf_dir), ["ORIGIN_AIRPORT"])
    return cluster.locate_keys(best, "ORIGIN_AIRPORT", _places(spark, sf_dir), "NAME", "LAT", "LON")


_ROUTES = f"""{_LABELLED}, {_PLACES}, {_dominant('ORIGIN_AIRPORT, DESTINATION_AIRPORT')}, routes as (
  select distinct ORIGIN_AIRPORT, DESTINATION_AIRPORT, cluster, "count", a.lat as start_lat, a.lon as start_lon,
  b.lat as end_lat, b.lon as end_lon from best join places a on a.name = ORIGIN_AIRPORT
  join places b on b.name = DESTINATION_AIRPORT
  where a.lon > -130 and a.lon < -60 and a.lat > 20 and a.lat < 50
  and b.lon > -130 and b.lon < -60 and b.lat > 20 and b.lat < 50)"""


def _routes(spark, sf_dir):
    ends = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"]
    best = cluster.dominant_cluster(_labelled(spark, sf_dir), ends)
    return cluster.locate_routes(best, *ends, _places(spark, sf_dir), "name", "lat", "lon")


@query("dominant_by_route", "K12 J3 F6 F11 P10 V8", f"{_ROUTES} select * from routes")
def _(spark, sf_dir):
    return _routes(spark, sf_dir)


@query(
    "frequent_routes", "K13 A14 V8",
    f"""{_ROUTES} select * from routes where "count" >= (select quantile_cont("count"::double, 0.9) from routes)""",
)
def _(spark, sf_dir):
    return cluster.frequent_routes(_routes(spark, sf_dir))


@query(
    "category_means", "K14 A3 P9",
    f"{_LABELLED} " + sql_union(
        [
            f"select '{c}' as category, cast({c} as varchar) as value, '{n}' as measure, {sql_round(f'avg({n})', 6)} as mean "
            f"from labelled group by {c}"
            for c in ["AIRLINE", "period", "DAY_OF_WEEK"] for n in _NUMBERS
        ]
    ),
)
def _(spark, sf_dir):
    return cluster.category_means(_labelled(spark, sf_dir), ["AIRLINE", "period", "DAY_OF_WEEK"], _NUMBERS)


# --- models -------------------------------------------------------------------------------------

def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").alias("cluster")
    )


@query(
    "silhouette", "K2",
    """with x as (select vec_id, label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as d from embeddings),
    dims as (select label, d, sum(v) as s from x group by 1, 2), sizes as (select label, count(*)::double as n from embeddings group by 1),
    norms as (select vec_id, label, sum(v * v) as q from x group by 1, 2),
    totals as (select label, sum(q) as q from norms group by 1),
    dots as (select x.vec_id, dims.label as other, sum(x.v * dims.s) as p from x join dims using (d) group by 1, 2),
    gaps as (select norms.vec_id, norms.label, dots.other, n, q_row, (n * q_row + tq - 2 * p) as total from
      (select vec_id, label, q as q_row from norms) norms join dots using (vec_id)
      join (select sizes.label as other, n, q as tq from sizes join totals using (label)) using (other)),
    ab as (select vec_id, max(n) filter (where other = label) as own,
      max(case when n > 1 then total / (n - 1) end) filter (where other = label) as a,
      min(total / n) filter (where other <> label) as b from gaps group by 1)
    select cast(round(avg(case when own = 1 then 0 when a < b then 1 - a / b when a > b then b / a - 1 else 0 end), 4) as double)
    as silhouette from ab""",
)
def _(spark, sf_dir):
    score = cluster.silhouette(_vectors(spark, sf_dir))
    return spark.createDataFrame([(float(score),)], "score double").select(F.round("score", 4).alias("silhouette"))


@query("kmeans_assign", "K3 K4")
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir).drop("cluster")
    return cluster.assign(cluster.fit_kmeans(vectors), vectors, ["vec_id"])


# The twin holds what a settled clustering has to meet: labels of all rows, of the nearest mean, and centres which are the means.
@query(
    "kmeans_settled", "K1 K3",
    "select unnest(range(2, 11))::int as k, (select count(*) from embeddings) as labelled, 0::bigint as nearer_elsewhere, true as centres_are_means",
)
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir).select(vector_to_array("features").alias("features"))
    found = kmeans.fit(vectors, cluster.SWEEP, rounds=300, tolerance=1e-9)
    result = None
    for k, fit in found.items():
        checked = kmeans.settled(fit.transform(vectors), fit).withColumn("k", F.lit(k)).select("k", "labelled", "nearer_elsewhere", "centres_are_means")
        result = checked if result is None else result.unionByName(checked)
    return result


@query("attach_label", "K4 J4", "select vec_id, label as cluster, cast(vec_id % 3 as bigint) as third from embeddings")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    labels = df.select("vec_id", F.col("label").alias("cluster"))
    return cluster.attach_label(df.select("vec_id", (F.col("vec_id") % 3).alias("third")), labels, ["vec_id"])


@query("k_sweep", "K1 K2 K3")
def _(spark, sf_dir):
    return cluster.sweep_k(_vectors(spark, sf_dir).drop("cluster"))


def _tokens(spark, sf_dir):
    wanted = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "MONTH"]
    return encode.tokenise(encode.category_document(movements(spark, sf_dir).select(*wanted), wanted)).select("category_doc", "tokens")


_TOKENS = f"""{MOVEMENTS}, docs as (select list_filter(string_split(lower(concat_ws(' ', 'AIRLINE_' || AIRLINE, 'ORIGIN_AIRPORT_' || ORIGIN_AIRPORT,
  'DESTINATION_AIRPORT_' || DESTINATION_AIRPORT, 'MONTH_' || MONTH)), ' '), lambda x: x <> '') as t from movements)"""


@query(
    "token_cooccurrences", "N11 N9 N10",
    f"""{_TOKENS}, cells as (select row_number() over () as d, t from docs), places as (select d, unnest(t) as w, generate_subscripts(t, 1) as i from cells),
    known as (select w from places group by 1 having count(*) >= 5)
    select a.w as word, b.w as context, count(*) as n from places a join places b on a.d = b.d and a.i <> b.i and abs(a.i - b.i) <= 7
    where a.w in (select w from known) and b.w in (select w from known) group by 1, 2""",
)
def _(spark, sf_dir):
    return embedding.cooccurrences(_tokens(spark, sf_dir), window=7, min_count=5)


@query("category_embed", "N11 N7 N8 N10")
def _(spark, sf_dir):
    documents = _tokens(spark, sf_dir)
    embedded = cluster.fit_embedding(documents).transform(documents.distinct())
    return embedded.select("category_doc", vector_to_array("category_vec").alias("vector"))


@query("w2v_embed", "N11 N7 N8 N10")
def _(spark, sf_dir):
    # Written: the vocabulary, the training and the result each read the documents.
    documents = stage(_tokens(spark, sf_dir), "documents")
    embedded = cluster.fit_word2vec(documents, maxIter=1).transform(documents.distinct())
    return embedded.select("category_doc", vector_to_array("category_vec").alias("vector"))
