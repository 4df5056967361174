"""Regression and feature selection."""

from pyspark.sql import functions as F

from punctual.catalog.base import query, sql_hash, sql_round, sql_union
from punctual.catalog.frames import LINE_KEY, MOVEMENTS, movements
from punctual.functions import HASH_SPACE, stable_hash
from punctual.operators import boosting, regress, selection
from punctual.staging import stage

_FEATURES = ["DEPARTURE_DELAY", "TAXI_OUT", "DISTANCE", "AIR_TIME", "FLIGHT_NUMBER"]
# More columns than the selectors keep.
_CANDIDATES = [
    *_FEATURES, "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL", "SCHEDULED_TIME", "TAXI_IN", "WHEELS_OFF",
]
_LABEL = "ARRIVAL_DELAY"
_SHARE = 0.8

_BASE = f"""{MOVEMENTS}, base as (select *, cast(l_linenumber % 3 as integer) as cluster,
  case when {sql_hash(*LINE_KEY)} < cast(floor({_SHARE} * {HASH_SPACE}) as bigint) then 'train' else 'test' end as split
  from movements)"""


def _base(spark, sf_dir):
    in_train = stable_hash(*LINE_KEY) < int(_SHARE * HASH_SPACE)
    return movements(spark, sf_dir).withColumns(
        {
            "cluster": (F.col("l_linenumber") % 3).cast("int"),
            "split": F.when(in_train, "train").otherwise("test"),
        }
    )


def _frames(spark, sf_dir):
    base = _base(spark, sf_dir)
    return {name: base.filter(F.col("split") == name) for name in ["train", "test"]}


def _written_frames(spark, sf_dir, features=_FEATURES):
    """The frames with the columns of a fit, from one written table: fits and scores don't join the tables again."""
    base = stage(_base(spark, sf_dir).select("cluster", "split", *features, _LABEL), "model-rows")
    return {name: base.filter(F.col("split") == name) for name in ["train", "test"]}


def _train(spark, sf_dir):
    return _frames(spark, sf_dir)["train"]


_LINE = f"""line as (select cluster, regr_slope({_LABEL}, DEPARTURE_DELAY) as slope,
  regr_intercept({_LABEL}, DEPARTURE_DELAY) as intercept from base where split = 'train' group by 1)"""


@query(
    "ols_one_feature", "M2",
    f"{_BASE}, {_LINE} select cluster, {sql_round('slope', 4)} as slope, {sql_round('intercept', 4)} as intercept from line",
)
def _(spark, sf_dir):
    return regress.simple_regression(_frames(spark, sf_dir)["train"], "DEPARTURE_DELAY", _LABEL)


_TWO = """two as (select cluster, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) as b1,
    (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) as b2, m1, m2, my from (
    select cluster, covar_pop(DEPARTURE_DELAY, ARRIVAL_DELAY) as c1y, covar_pop(DISTANCE, ARRIVAL_DELAY) as c2y,
    covar_pop(DEPARTURE_DELAY, DISTANCE) as c12, var_pop(DEPARTURE_DELAY) as v1, var_pop(DISTANCE) as v2,
    avg(DEPARTURE_DELAY) as m1, avg(DISTANCE) as m2, avg(ARRIVAL_DELAY) as my from base where split = 'train' group by 1))"""
_TERMS = {"DEPARTURE_DELAY": "b1", "DISTANCE": "b2", "intercept": "my - b1 * m1 - b2 * m2"}


@query(
    "ols_two_features", "M3",
    f"{_BASE}, {_TWO} " + sql_union(
        [f"select cluster, '{t}' as term, {sql_round(v, 4)} as coefficient from two" for t, v in _TERMS.items()]
    ),
)
def _(spark, sf_dir):
    return regress.linear_closed_form(_frames(spark, sf_dir)["train"], ["DEPARTURE_DELAY", "DISTANCE"], _LABEL)


_SCORES = f"""sqrt(avg(e * e)) as rmse, avg(abs(e)) as mae, 1 - sum(e * e) / (var_pop({_LABEL}) * count(*)) as r2"""
_ROUNDED = ", ".join(f"{sql_round(m, 4)} as {m}" for m in ["rmse", "mae", "r2"])
_LINE_ERRORS = f"""{_BASE}, {_LINE}, errors as (select base.*, {_LABEL} - (slope * DEPARTURE_DELAY + intercept) as e
  from base join line using (cluster))"""
_MEAN_ERRORS = f"""means as (select cluster, avg({_LABEL}) as mean from base where split = 'train' group by 1),
flat as (select base.*, {_LABEL} - mean as e from base join means using (cluster))"""


def _line_predictions(spark, sf_dir):
    base = _base(spark, sf_dir).select("cluster", "split", "DEPARTURE_DELAY", _LABEL)
    line = base.filter(F.col("split") == "train").groupBy("cluster").agg(
        F.regr_slope(_LABEL, "DEPARTURE_DELAY").alias("slope"), F.regr_intercept(_LABEL, "DEPARTURE_DELAY").alias("intercept")
    )
    fitted = F.col("slope") * F.col("DEPARTURE_DELAY") + F.col("intercept")
    return base.join(line, "cluster").withColumn("prediction", fitted)


@query(
    "regression_metrics", "M1 M2 M9",
    f"{_LINE_ERRORS}, scores as (select cluster, split, {_SCORES} from errors group by 1, 2) select cluster, split, {_ROUNDED} from scores",
)
def _(spark, sf_dir):
    return regress.regression_scores(_line_predictions(spark, sf_dir), _LABEL, ["cluster", "split"])


@query(
    "model_table", "M10 A10 U1",
    f"""{_LINE_ERRORS}, {_MEAN_ERRORS}, scores as (
      select cluster, split, 'line' as model, {_SCORES} from errors group by 1, 2
      union all select cluster, split, 'mean' as model, {_SCORES} from flat group by 1, 2)
    select cluster, split, {sql_round("max(rmse) filter (where model = 'line')", 4)} as line,
    {sql_round("max(rmse) filter (where model = 'mean')", 4)} as mean from scores group by 1, 2""",
)
def _(spark, sf_dir):
    line = _line_predictions(spark, sf_dir)
    base = _base(spark, sf_dir).select("cluster", "split", _LABEL)
    mean = base.filter(F.col("split") == "train").groupBy("cluster").agg(F.avg(_LABEL).alias("prediction"))
    scores = {
        "line": regress.regression_scores(line, _LABEL, ["cluster", "split"]),
        "mean": regress.regression_scores(base.join(mean, "cluster"), _LABEL, ["cluster", "split"]),
    }
    return regress.compare_models(scores, "rmse")


def _fit_and_score(spark, sf_dir, kind, features, frames=None, **settings):
    frames = frames or _written_frames(spark, sf_dir, features)
    models = regress.fit_per_cluster(frames["train"], features, _LABEL, kind, **settings)
    return models, regress.score_per_cluster(models, frames, features, _LABEL)


@query(
    "linear_fit", "M2 M9 M11 P8",
    f"{_LINE_ERRORS}, scores as (select cluster, split, {_SCORES} from errors group by 1, 2) select cluster, split, {_ROUNDED} from scores",
)
def _(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "linear", ["DEPARTURE_DELAY"])[1]


@query(
    "linear_coefficients", "M3 M11",
    f"{_BASE}, {_TWO} " + sql_union(
        [f"select cluster, '{t}' as term, {sql_round(v, 4)} as coefficient from two" for t, v in _TERMS.items()]
    ),
)
def _(spark, sf_dir):
    features = ["DEPARTURE_DELAY", "DISTANCE"]
    train = _frames(spark, sf_dir)["train"]
    return regress.coefficients(regress.fit_per_cluster(train, features, _LABEL, "linear"), features, train)


@query("tree_fit", "M4 M9 M11")
def _(spark, sf_dir):
    frames = _written_frames(spark, sf_dir)
    return boosting.score_models(boosting.fit_trees(frames["train"], _FEATURES, _LABEL), frames, _FEATURES, _LABEL)


# Columns with so few values that every value but the greatest is a cut.
_FEW = ["MONTH", "DAY_OF_WEEK"]


def _sql_level(name: str, rows: str) -> str:
    """Best split of each node of a level: rows (cluster, node, MONTH, DAY_OF_WEEK, y)."""
    cells = " union all ".join(f"select cluster, node, {i} as f, {c}::double as x, y from {rows}" for i, c in enumerate(_FEW))
    return f"""{name}_sums as (select cluster, node, f, x, count(*)::double as n, sum(y) as s from ({cells}) group by all),
    {name}_cuts as (select cluster, node, f, x, sum(n) over below as ln, sum(s) over below as ls, sum(n) over (partition by cluster, node, f) as n,
      sum(s) over (partition by cluster, node, f) as s from {name}_sums window below as (partition by cluster, node, f order by x)),
    {name} as (select * from (select *, row_number() over (partition by cluster, node order by ls * ls / ln + (s - ls) * (s - ls) / (n - ln) desc, f, x) as k
      from {name}_cuts where n > ln) where k = 1)"""


_GOES = "case when case b.f when 0 then MONTH else DAY_OF_WEEK end <= b.x then 2 * r.node + 1 else 2 * r.node + 2 end"


@query(
    "tree_nodes", "M4",
    f"""{_BASE}, rows0 as (select cluster, 0 as node, MONTH, DAY_OF_WEEK, {_LABEL}::double as y from base
      where split = 'train' and MONTH is not null and DAY_OF_WEEK is not null and {_LABEL} is not null), {_sql_level("best0", "rows0")},
    rows1 as (select r.cluster, {_GOES} as node, MONTH, DAY_OF_WEEK, y from rows0 r join best0 b on b.cluster = r.cluster and b.node = r.node),
    {_sql_level("best1", "rows1")}, best as (select * from best0 union all select * from best1),
    rows2 as (select r.cluster, {_GOES} as node, y from rows1 r join best1 b on b.cluster = r.cluster and b.node = r.node),
    every as (select cluster, node, y from rows0 union all select cluster, node, y from rows1 union all select cluster, node, y from rows2),
    means as (select cluster, node, avg(y) as value from every group by 1, 2)
    select m.cluster, 0::int as tree, m.node::int as node, case b.f when 0 then 'MONTH' when 1 then 'DAY_OF_WEEK' end as feature, b.x as threshold,
      {sql_round("m.value", 4)} as value
    from means m left join best b on b.cluster = m.cluster and b.node = m.node""",
)
def _(spark, sf_dir):
    train = _train(spark, sf_dir)
    return boosting.nodes(boosting.fit_trees(train, _FEW, _LABEL, maxDepth=2, minInstancesPerNode=1), train)


@query("forest_fit", "M5 M9 M11")
def _(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "forest", _FEATURES)[1]


@query("gbt_fit", "M6 M9 M11")
def _(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "boosting", _FEATURES, _frames(spark, sf_dir))[1]


@query("forest_importances", "M5 L3")
def _(spark, sf_dir):
    train = _frames(spark, sf_dir)["train"]
    models = regress.fit_per_cluster(train, _FEATURES, _LABEL, "forest")
    return regress.importances(models, _FEATURES, train)


@query("gbt_importances", "M6")
def _(spark, sf_dir):
    train = _frames(spark, sf_dir)["train"]
    models = regress.fit_per_cluster(train, _FEATURES, _LABEL, "boosting")
    return regress.importances(models, _FEATURES, train)


@query("tune_forest", "M7 M9 M11")
def _(spark, sf_dir):
    frames = _written_frames(spark, sf_dir)
    models, report = regress.tune_per_cluster(frames["train"], _FEATURES, _LABEL, "forest", regress.FOREST_GRID)
    return regress.scored_report(report, regress.score_per_cluster(models, frames, _FEATURES, _LABEL), list(frames))


@query("tune_gbt", "M8 M9")
def _(spark, sf_dir):
    frames = _written_frames(spark, sf_dir)
    tuned = boosting.tune(frames["train"], _FEATURES, _LABEL, regress.BOOSTING_GRID)
    return boosting.score(tuned, frames, _FEATURES, _LABEL)


@query("model_compare", "M10 M3 M4")
def _(spark, sf_dir):
    frames = _written_frames(spark, sf_dir)
    scores = {kind: _fit_and_score(spark, sf_dir, kind, _FEATURES, frames)[1] for kind in ["linear", "tree"]}
    return regress.compare_models(scores, "rmse")


@query("forest_top", "L3")
def _(spark, sf_dir):
    return selection.forest_importance(_train(spark, sf_dir), _CANDIDATES, _LABEL)


@query("forest_matrix", "L3 L4")
def _(spark, sf_dir):
    return selection.importance_matrix(selection.forest_importance(_train(spark, sf_dir), _CANDIDATES, _LABEL), [0, 1, 2])


@query("rfe", "L5")
def _(spark, sf_dir):
    return selection.recursive_elimination(_train(spark, sf_dir), _CANDIDATES, _LABEL)


@query("elimination_matrix", "L5 L6")
def _(spark, sf_dir):
    return selection.selected_matrix(selection.recursive_elimination(_train(spark, sf_dir), _CANDIDATES, _LABEL), [0, 1, 2])


@query("lasso_select", "L7")
def _(spark, sf_dir):
    return selection.lasso_selection(_train(spark, sf_dir), _CANDIDATES, _LABEL)


@query("lasso_matrix", "L7 L8")
def _(spark, sf_dir):
    return selection.coefficient_matrix(selection.lasso_selection(_train(spark, sf_dir), _CANDIDATES, _LABEL), [0, 1, 2])


# The twin holds the conditions of the optimum, which residuals made row by row have to meet.
@query(
    "lasso_optimal", "L7",
    f"{_BASE} select cluster, feature, true as optimal from (select distinct cluster from base where split = 'train'), "
    f"(select unnest({_CANDIDATES}) as feature)",
)
def _(spark, sf_dir):
    return selection.lasso_conditions(_train(spark, sf_dir), _CANDIDATES, _LABEL)


@query("majority_vote", "L10 L3 L5 L7 L9")
def _(spark, sf_dir):
    base = stage(_train(spark, sf_dir).select("cluster", *_CANDIDATES, _LABEL), "vote-rows")
    ranked = selection.spearman_ranking(base, _CANDIDATES, _LABEL)
    with selection.shared_forests():
        ballots = {
            "forest": selection.forest_importance(base, _CANDIDATES, _LABEL),
            "elimination": selection.recursive_elimination(base, _CANDIDATES, _LABEL),
            "lasso": selection.lasso_selection(base, _CANDIDATES, _LABEL),
            "spearman": ranked.filter(F.col("rank") <= selection.TOP),
        }
    return selection.vote_matrix(selection.vote(ballots), [0, 1, 2])
