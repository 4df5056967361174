"""From complete flights to modelling tables: sample, split, repair, engineer, cap, encode, check, trim."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions import day_period, minutes_of_day, route, season, weekend_flag
from punctual.operators import codes, encode, keys, outliers
from punctual.operators.features import DELAY_LIMIT, with_known_delay
from punctual.plans import columns as names
from punctual.staging import stage


@dataclass(frozen=True)
class PreparedSplits:
    frames: dict[str, DataFrame]
    one_hot: PipelineModel
    frequencies: dict[str, encode.FrequencyModel]
    cap: float | None


def repair_places(flights: DataFrame, pairs: DataFrame) -> DataFrame:
    """Replace numeric place codes; the map is brought to one label per code first, so no row multiplies."""
    places = names.PLACES
    repaired = codes.replace_codes(flights, places, pairs)
    return repaired.select(
        *[F.col(f"{c}_clean").alias(c) if c in places else F.col(c) for c in flights.columns]
    )


def engineer(flights: DataFrame, wrap: bool = True) -> DataFrame:
    """Calendar, clock and route features in one projection."""
    featured = flights.withColumns(
        {
            "SEASON": season("MONTH"),
            "SCHEDULED_DEPARTURE_PERIOD": day_period("SCHEDULED_DEPARTURE"),
            "IS_WEEKEND": weekend_flag("DAY_OF_WEEK"),
            "DELAYED_DEPARTURE_FLAG": (F.col("DEPARTURE_DELAY") > DELAY_LIMIT).cast("int"),
            "ROUTE": route(*names.PLACES),
            **{out: minutes_of_day(c, wrap) for c, out in names.CLOCKS.items()},
        }
    )
    return with_known_delay(featured, names.CAUSES, "TOTAL_KNOWN_DELAY")


def prepare_splits(
    flights: DataFrame,
    pairs: DataFrame,
    row_key: Sequence[str] = tuple(names.FLIGHT_KEY),
    fraction: float = names.SAMPLE_FRACTION,
    cap_quantile: float = names.CAP_QUANTILE,
    relative_error: float = 0.0,
    label: str = "split",
) -> PreparedSplits:
    """Indexed, cleaned and encoded train, validation and test tables.

    Caps, categories and frequencies are fitted on the training rows only. ``row_key`` identifies a
    flight and ends the order of the index, which is dense within each split.
    """
    # The sample is written once, so that the passes below read it and not all flights.
    sampled = stage(keys.stable_sample(flights, row_key, fraction), "sample")
    labelled = keys.stratified_split(sampled, "MONTH", row_key, label=label)
    order = list(dict.fromkeys([*names.INDEX_ORDER, *row_key]))
    indexed = keys.global_index(labelled, order, within=label)
    wide = indexed.withColumn("DISTANCE", F.col("DISTANCE").cast("double"))
    featured = engineer(repair_places(wide, codes.preferred_labels(pairs)))

    train = featured.filter(F.col(label) == "train")
    cap = outliers.fit_cap(train, "DISTANCE", cap_quantile, relative_error)
    one_hot = encode.fit_one_hot(train, names.ONE_HOT)
    frequencies = encode.fit_frequencies(train, names.FREQUENCY, relative_error=relative_error)

    # All splits are encoded in one pass; only validation and test rows take the fill.
    encoded = one_hot.transform(outliers.cap_above(featured, "DISTANCE", cap))
    filled = {}
    for c, model in frequencies.items():
        encoded = encode.apply_frequencies(encoded, replace(model, fill=None))
        known = F.col(f"{c}_freq")
        filled[f"{c}_freq"] = F.when(F.col(label) == "train", known).otherwise(F.coalesce(known, F.lit(model.fill)))
    encoded = encoded.withColumns(filled)
    kept = outliers.filter_min(encoded, "DEPARTURE_DELAY", names.DELAY_FLOOR).drop(*names.TABLE_DROPS)
    # The finished rows are written by split: the paths behind this one read them many times.
    table = stage(kept, "prepared", partition_by=label)
    frames = {name: table.filter(F.col(label) == name).drop(label) for name in keys.SPLIT_PERCENT}
    return PreparedSplits(frames, one_hot, frequencies, cap)
