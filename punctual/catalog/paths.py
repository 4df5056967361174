"""Whole paths: preparation, edge table, clustering and regression."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_hash, sql_round
from punctual.catalog.features import PERIOD_SQL, SEASON_SQL
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, movements, place_pairs
from punctual.functions import HASH_SPACE
from punctual.operators import regress
from punctual.plans import cluster_splits, edge_table, filter_complete, prepare_regression, prepare_splits, select_features
from punctual.plans.columns import CAUSES, CLOCKS, FREQUENCY, INDEX_ORDER

_FRACTION = 0.4
_COMPLETE = " and ".join(f"{c} is not null" for c in CAUSES)
_SAMPLED = f"""{MOVEMENTS}, sampled as (select *, {sql_hash(*LINE_KEY)} as h from movements where {_COMPLETE}
  and {sql_hash(*LINE_KEY)} < cast(floor({_FRACTION} * {HASH_SPACE}) as bigint)),
places as (select cast(n_nationkey as varchar) as code, n_name as label from nation)"""


def _engineered(source: str, wrap: bool) -> str:
    minutes = ", ".join(
        f"cast(({c} // 100 * 60 + {c} % 100){' % 1440' if wrap else ''} as bigint) as {out}" for c, out in CLOCKS.items()
    )
    return f"""repaired as (select s.* exclude (ORIGIN_AIRPORT, DESTINATION_AIRPORT), coalesce(a.label, ORIGIN_AIRPORT)
  as ORIGIN_AIRPORT, coalesce(b.label, DESTINATION_AIRPORT) as DESTINATION_AIRPORT from {source} s
  left join places a on a.code = ORIGIN_AIRPORT left join places b on b.code = DESTINATION_AIRPORT),
engineered as (select *, {SEASON_SQL.format(m='MONTH')} as SEASON, {PERIOD_SQL.format(c='SCHEDULED_DEPARTURE')}
  as SCHEDULED_DEPARTURE_PERIOD, cast(DAY_OF_WEEK >= 6 as integer) as IS_WEEKEND,
  cast(DEPARTURE_DELAY > 15 as integer) as DELAYED_DEPARTURE_FLAG,
  ORIGIN_AIRPORT || '_' || DESTINATION_AIRPORT as ROUTE, {' + '.join(f'coalesce({c}, 0)' for c in CAUSES)} as TOTAL_KNOWN_DELAY,
  {minutes} from repaired)"""


_KEPT = [
    "index", *LINE_KEY, "MONTH", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ROUTE", "SEASON", "SCHEDULED_DEPARTURE_PERIOD",
    "IS_WEEKEND", "DELAYED_DEPARTURE_FLAG", "TOTAL_KNOWN_DELAY", "SCHEDULED_DEPARTURE_min", "WHEELS_OFF_min", "DISTANCE",
    "DEPARTURE_DELAY", "ARRIVAL_DELAY",
]
_ORDER = ", ".join(dict.fromkeys([*INDEX_ORDER, *LINE_KEY]))


def _frequency_ctes() -> str:
    total = "(select count(*) from engineered where split = 'train')"
    return ", ".join(
        f"f_{c} as (select {c}, {sql_round(f'count(*) * 1e0 / {total}', 6)} as f from engineered where split = 'train' group by 1)"
        for c in FREQUENCY
    )


def _frequency_columns() -> str:
    return ", ".join(
        f"coalesce(f_{c}.f, (select quantile_disc(f, 0.5) from f_{c})) as {c}_freq" for c in FREQUENCY
    )


_SHOWN = ", ".join(
    f"cast(least({c}, (select quantile_disc(DISTANCE, 0.975) from engineered where split = 'train')) as double) as {c}"
    if c == "DISTANCE" else f"e.{c}"
    for c in _KEPT
)


@query(
    "modelling_tables", "T1 W1 W2 W3 D2 D5 D6 D9 E1 E2 E3 E4 E5 E6 E7 E11 N3 N4 Q11",
    f"""{_SAMPLED}, ranked as (select *, row_number() over (partition by MONTH order by h, {LINE_KEY_SQL}) as rn,
      count(*) over (partition by MONTH) as n from sampled),
    labelled as (select *, case when rn * 100 <= n * 70 then 'train' when rn * 100 <= n * 85 then 'val' else 'test' end as split
      from ranked),
    indexed as (select *, row_number() over (partition by split order by {_ORDER}) as index from labelled),
    {_engineered('indexed', True)}, {_frequency_ctes()}
    select e.split, {_SHOWN}, {_frequency_columns()} from engineered e
    {' '.join(f'left join f_{c} on f_{c}.{c} = e.{c}' for c in FREQUENCY)} where DEPARTURE_DELAY >= -10""",
)
def _(spark, sf_dir):
    prepared = prepare_splits(_complete(spark, sf_dir), place_pairs(spark, sf_dir), LINE_KEY, _FRACTION)
    parts = [
        df.select(F.lit(name).alias("split"), *_KEPT, *[f"{c}_freq" for c in FREQUENCY])
        for name, df in prepared.frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _complete(spark, sf_dir):
    return filter_complete(movements(spark, sf_dir))


@query(
    "graph_prep", "G1 G2 G3 D2 D5 D6 E8 E10 F10",
    f"""{_SAMPLED}, {_engineered('sampled', False)}, flagged as (select *, DEPARTURE_TIME_min + AIR_TIME as TOTAL_FLIGHT_MIDNIGHT_min,
      cast(DEPARTURE_TIME_min + AIR_TIME >= 1440 as integer) as CROSSES_MIDNIGHT_FLAG,
      (select quantile_disc(DISTANCE, 0.975) from engineered) as cap from engineered)
    select * exclude (h, cap, DISTANCE, SCHEDULED_DEPARTURE, SCHEDULED_ARRIVAL, DEPARTURE_TIME, WHEELS_OFF,
      DELAYED_DEPARTURE_FLAG, TOTAL_KNOWN_DELAY, CANCELLATION_REASON), cast(least(DISTANCE, cap) as double) as DISTANCE from flagged
    where DEPARTURE_DELAY >= 0 and DEPARTURE_TIME_min >= SCHEDULED_DEPARTURE_min and not (
      (CROSSES_MIDNIGHT_FLAG <> 1 and WHEELS_OFF_min < DEPARTURE_TIME_min) or WHEELS_ON < WHEELS_OFF
      or ARRIVAL_TIME < WHEELS_ON or SCHEDULED_ARRIVAL_min < SCHEDULED_DEPARTURE_min)""",
)
def _(spark, sf_dir):
    return edge_table(_complete(spark, sf_dir), place_pairs(spark, sf_dir), LINE_KEY, _FRACTION)


@query("clustered_tables", "K3 K4 N7 N8 N9 N10 N11 E11")
def _(spark, sf_dir):
    prepared = prepare_splits(_complete(spark, sf_dir), place_pairs(spark, sf_dir), LINE_KEY, _FRACTION)
    clustered = cluster_splits(prepared.frames)
    parts = [df.select(F.lit(name).alias("split"), "index", "cluster") for name, df in clustered.frames.items()]
    return reduce(DataFrame.unionByName, parts)


@query("regression_path", "J4 L1 L2 L3 L5 L7 L9 L10 M3 M9")
def _(spark, sf_dir):
    prepared = prepare_splits(_complete(spark, sf_dir), place_pairs(spark, sf_dir), LINE_KEY, _FRACTION)
    clustered = cluster_splits(prepared.frames)
    labels = {name: df.select("index", "cluster") for name, df in clustered.frames.items()}
    frames, features = prepare_regression(prepared.frames, labels)
    chosen, _ = select_features(frames["train"], features)
    models = regress.fit_per_cluster(frames["train"], chosen, "ARRIVAL_DELAY", "linear")
    return regress.score_per_cluster(models, frames, chosen, "ARRIVAL_DELAY")
