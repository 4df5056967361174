"""Coherence of times and delays."""

from punctual.catalog.base import query
from punctual.catalog.frames import LINE_KEY, LINE_KEY_SQL, MOVEMENTS, movements
from punctual.operators import coherence, features
from punctual.plans.columns import CAUSES, CLOCKS

_ON_DAY = {"SCHEDULED_DEPARTURE": "sched", "DEPARTURE_TIME": "dep", "SCHEDULED_ARRIVAL": "due"}


def _m(c: str, wrap: bool = True) -> str:
    return f"({c} // 100 * 60 + {c} % 100)" + (" % 1440" if wrap else "")


_TIMED = f"""{MOVEMENTS}, timed as (select *, {_m('SCHEDULED_DEPARTURE')} as sched, {_m('DEPARTURE_TIME')} as dep,
  {_m('SCHEDULED_ARRIVAL')} as due from movements)"""
_ARRIVAL = f"""{_TIMED}, compared as (select *, cast(due - (sched + SCHEDULED_TIME) % 1440 as bigint) as difference,
  cast((sched + SCHEDULED_TIME) % 1440 as bigint) as expected from timed)"""


def _timed(spark, sf_dir):
    return features.with_clock_minutes(movements(spark, sf_dir), _ON_DAY)


def _arrival(spark, sf_dir):
    return coherence.clock_difference(_timed(spark, sf_dir), "sched", "SCHEDULED_TIME", "due", reverse=True)


@query(
    "clock_coherence", "Q13 C2 C13",
    f"""{_TIMED} select {LINE_KEY_SQL}, cast((sched + DEPARTURE_DELAY + 1440) % 1440 as bigint) as expected,
    cast((sched + DEPARTURE_DELAY + 1440) % 1440 - dep as bigint) as difference from timed""",
)
def _(spark, sf_dir):
    checked = coherence.clock_difference(_timed(spark, sf_dir), "sched", "DEPARTURE_DELAY", "dep")
    return checked.select(*LINE_KEY, "expected", "difference")


@query(
    "clock_mismatch_count", "Q13 Q14 A6",
    f"{_ARRIVAL} select count(*) filter (where difference <> 0) as mismatches, count(*) as total from compared",
)
def _(spark, sf_dir):
    return coherence.mismatch_summary(_arrival(spark, sf_dir))


@query(
    "clock_worst", "Q14 O2 C5",
    f"""{_ARRIVAL} select {LINE_KEY_SQL}, expected, difference from compared
    order by abs(difference) desc, {LINE_KEY_SQL} limit 20""",
)
def _(spark, sf_dir):
    return coherence.worst_first(_arrival(spark, sf_dir), "difference", LINE_KEY, 20).select(*LINE_KEY, "expected", "difference")


@query(
    "clock_diff_histogram", "Q14 F8 A2",
    f"""{_ARRIVAL} select difference, count(*) as "count" from compared where difference <> 0 group by 1""",
)
def _(spark, sf_dir):
    return coherence.difference_histogram(_arrival(spark, sf_dir))


@query(
    "early_rows", "Q15 F7 A12",
    f"""{_TIMED} select distinct DEPARTURE_DELAY, cast(sched as bigint) as sched, cast(dep as bigint) as dep from timed
    where DEPARTURE_DELAY < 0""",
)
def _(spark, sf_dir):
    return coherence.early_values(_timed(spark, sf_dir), "DEPARTURE_DELAY", ["sched", "dep"])


@query("early_count", "Q15 A6", f"{MOVEMENTS} select count(*) as early_rows from movements where DEPARTURE_DELAY < -10")
def _(spark, sf_dir):
    return coherence.early_count(movements(spark, sf_dir), "DEPARTURE_DELAY", -10)


@query(
    "zero_cause_check", "Q16 F2 F3",
    f"""{MOVEMENTS} select {LINE_KEY_SQL} from movements where {' and '.join(f'{c} = 0' for c in CAUSES)}
    and (SCHEDULED_ARRIVAL <> ARRIVAL_TIME or SCHEDULED_DEPARTURE <> DEPARTURE_TIME)""",
)
def _(spark, sf_dir):
    pairs = [("SCHEDULED_ARRIVAL", "ARRIVAL_TIME"), ("SCHEDULED_DEPARTURE", "DEPARTURE_TIME")]
    return coherence.zero_cause_conflicts(movements(spark, sf_dir), CAUSES, pairs).select(*LINE_KEY)


_RAW = ", ".join(f"{_m(c, False)} as {o}" for c, o in CLOCKS.items())
_FLAGGED = f"""{MOVEMENTS}, flagged as (select *, {_RAW},
  cast({_m('DEPARTURE_TIME', False)} + AIR_TIME >= 1440 as integer) as crosses_midnight from movements)"""


def _flagged(spark, sf_dir):
    timed = features.with_clock_minutes(movements(spark, sf_dir), CLOCKS, wrap=False)
    return features.with_midnight_flag(timed, "DEPARTURE_TIME_min", "AIR_TIME")


@query(
    "early_departure_rules", "G3 F9",
    f"""{_FLAGGED} select {LINE_KEY_SQL} from flagged
    where DEPARTURE_DELAY >= 0 and DEPARTURE_TIME_min >= SCHEDULED_DEPARTURE_min""",
)
def _(spark, sf_dir):
    kept = coherence.drop_early_departures(
        _flagged(spark, sf_dir), "DEPARTURE_DELAY", "DEPARTURE_TIME_min", "SCHEDULED_DEPARTURE_min"
    )
    return kept.select(*LINE_KEY)


@query(
    "time_order_rules", "G2 F10",
    f"""{_FLAGGED} select {LINE_KEY_SQL}, crosses_midnight from flagged where not (
    (crosses_midnight <> 1 and WHEELS_OFF_min < DEPARTURE_TIME_min) or WHEELS_ON < WHEELS_OFF
    or ARRIVAL_TIME < WHEELS_ON or SCHEDULED_ARRIVAL_min < SCHEDULED_DEPARTURE_min)""",
)
def _(spark, sf_dir):
    kept = coherence.time_order(
        _flagged(spark, sf_dir), "crosses_midnight", ("DEPARTURE_TIME_min", "WHEELS_OFF_min"),
        [("WHEELS_OFF", "WHEELS_ON"), ("WHEELS_ON", "ARRIVAL_TIME"), ("SCHEDULED_DEPARTURE_min", "SCHEDULED_ARRIVAL_min")],
    )
    return kept.select(*LINE_KEY, "crosses_midnight")
