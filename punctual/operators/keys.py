"""Stable samples, exact stratified splits and dense indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.hashing import HASH_SPACE, stable_hash
from punctual.operators.joins import checked_broadcast
from punctual.staging import stage

HASH_BITS = 32
POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits

# Percent of each stratum per split.
SPLIT_PERCENT = {"train": 70, "val": 15, "test": 15}


def stable_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Bernoulli sample decided by the business key alone. A narrow filter."""
    return df.filter(stable_hash(*keys) < int(fraction * HASH_SPACE))


def stable_limit(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest key hash: a bounded preview which is the same on every run."""
    order = "_order"
    ranked = df.withColumn(order, stable_hash(*keys)).orderBy(order, *keys).limit(n)
    return ranked.drop(order)


def rank_in_stratum(df: DataFrame, stratum: Sequence[str], order_by: Sequence, rank: str, size: str) -> DataFrame:
    """Rank (long) and stratum size beside each row.

    Positions come from one range exchange over the stratum and the order, so a stratum holding most rows is spread over
    many tasks. ``order_by`` must be a total order inside the stratum. Null is a stratum like any other.
    """
    staged, offsets = _positions(df, list(stratum), order_by, None)
    keyed = _keyed(offsets, [*stratum, "_part"])
    return staged.join(keyed, _matches([*stratum, "_part"]), "inner").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).alias(rank), F.col("_all").alias(size))


def split_bounds(df: DataFrame, stratum: str, keys: Sequence[str], percents: Sequence[int], bits: int = 14) -> DataFrame:
    """Per stratum, the ordering key of the last row of each share.

    Rows are ordered by their hash. Counting rows per (stratum, leading hash bits) finds the bucket
    where a share ends; only the rows of those buckets are ranked. One row per stratum comes out,
    with one struct column ``bound_i`` per cumulative percentage (null if the share is empty).
    """
    hashed = df.select(stratum, stable_hash(*keys).alias("_hash"), *[k for k in keys if k != stratum])
    bucket = F.shiftright("_hash", HASH_BITS - bits).alias("_bucket")
    counted = hashed.groupBy(stratum, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(stratum)
    cumulative = counted.withColumns(
        {"_upto": F.sum("_rows").over(group.orderBy("_bucket")), "_all": F.sum("_rows").over(group)}
    )
    share = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(percents)]))
    before = F.col("_upto") - F.col("_rows")
    ends = (
        cumulative.withColumn("_share", share)
        .withColumn("_target", F.floor(F.col("_all") * F.col("_share.p") / F.lit(100)))
        .filter((F.col("_target") > before) & (F.col("_target") <= F.col("_upto")))
        .select(
            F.col(stratum).alias("_stratum"), F.col("_bucket").alias("_end_bucket"),
            F.col("_share.i").alias("_i"), (F.col("_target") - before).alias("_residual"),
        )
    )
    # One short row per stratum and share, used twice below.
    ends = ends.persist()
    order = ["_hash", *keys]
    buckets = checked_broadcast(ends.select("_stratum", "_end_bucket").distinct())
    inside = hashed.join(
        buckets,
        F.col(stratum).eqNullSafe(F.col("_stratum"))
        & (F.shiftright("_hash", HASH_BITS - bits) == F.col("_end_bucket")),
        "inner",
    )
    ranked = inside.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_stratum", "_end_bucket").orderBy(*order))
    ).select(
        F.col("_stratum").alias("_s"), F.col("_end_bucket").alias("_b"), "_rank", F.struct(*order).alias("_bound")
    )
    found = ends.join(
        ranked,
        F.col("_stratum").eqNullSafe(F.col("_s")) & (F.col("_end_bucket") == F.col("_b"))
        & (F.col("_residual") == F.col("_rank")),
        "inner",
    )
    return found.groupBy("_stratum").agg(
        *[F.max(F.when(F.col("_i") == i, F.col("_bound"))).alias(f"bound_{i}") for i in range(len(percents))]
    )


def stratified_split(
    df: DataFrame,
    stratum: str,
    keys: Sequence[str],
    shares: dict[str, int] | None = None,
    label: str = "split",
) -> DataFrame:
    """Label every row with its split; each stratum is divided by exact row counts.

    ``keys`` must identify a row. The rows themselves are not shuffled or sorted: each is compared with
    the bounds of its stratum, so a stratum holding most of the rows costs no more than the others.
    """
    shares = shares or SPLIT_PERCENT
    names = list(shares)
    cumulative, total = [], 0
    for name in names[:-1]:
        total += shares[name]
        cumulative.append(total)
    bounds = checked_broadcast(split_bounds(df, stratum, keys, cumulative).persist())
    position = F.struct(stable_hash(*keys).alias("_hash"), *keys)
    joined = df.withColumn("_position", position).join(bounds, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    chosen = F.coalesce(
        *[F.when(F.col("_position") <= F.col(f"bound_{i}"), F.lit(name)) for i, name in enumerate(names[:-1])],
        F.lit(names[-1]),
    )
    return joined.select(*df.columns, chosen.alias(label))


def global_index(
    df: DataFrame, order_by: Sequence[str], index: str = "index", within: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Dense index 1..n in the order of ``order_by``, put first, per ``within`` group if given.

    Range partitioning sorts across partitions and the position inside each is free, so the only
    shuffle is the range exchange and no task holds all rows or a whole group. The positions are staged
    before they are counted, because a partition computed again must not get other numbers.
    ``order_by`` must be a total order (inside the group).
    """
    group = [within] if within else []
    staged, offsets = _positions(df, group, order_by, partitions)
    return (
        staged.join(_keyed(offsets, [*group, "_part"]), _matches([*group, "_part"]), "inner")
        .select((F.col("_offset") + F.col("_place") + 1).alias(index), *df.columns)
    )


def _positions(df: DataFrame, group: list[str], order_by: Sequence, partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Staged rows with partition ``_part`` and position ``_place``, and per group and partition what to add (``_offset``)
    for a rank inside the group, with the group's rows (``_all``)."""
    order = [*group, *order_by]
    tagged = (
        (df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_tag", F.monotonically_increasing_id())
    )
    # Not partitioned by the group: folder names would turn empty text into null.
    staged = stage(tagged, "index")
    part = F.shiftright("_tag", POSITION_BITS)
    sizes = staged.groupBy(*group, part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition and group met in it: the windows and the broadcast are bounded by that.
    whole = Window.partitionBy(*group)
    earlier_groups = Window.partitionBy("_part").orderBy(*(group or ["_part"]))
    offsets = sizes.select(
        *group, "_part", F.sum("_rows").over(whole).alias("_all"),
        (F.sum("_rows").over(whole.orderBy("_part")) - F.sum("_rows").over(earlier_groups)).alias("_offset"),
    )
    position = F.col("_tag").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return staged.withColumns({"_part": part, "_place": position}), offsets


def _keyed(small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rename keys for a null-safe join; broadcast if its measured size allows it."""
    return checked_broadcast(small.withColumnsRenamed({k: f"_right_{k}" for k in keys}))


def _matches(keys: Sequence[str]):
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return match


def running_count(
    counts: DataFrame, group: str, value: str, amount: str, before: str, window_rows: int = 4_000_000
) -> DataFrame:
    """For each (group, value) row, the sum of ``amount`` over smaller values of its group.

    ``counts`` has one row per (group, value), so hot values are already one row. Up to
    ``window_rows`` rows a plain window per group does; beyond it the sums are taken per range
    partition and the partition totals are added, so that no task sorts a whole group.
    """
    if counts.limit(window_rows + 1).count() <= window_rows:
        w = Window.partitionBy(group).orderBy(value)
        return counts.withColumn(before, F.sum(amount).over(w) - F.col(amount))
    staged = stage(
        counts.repartitionByRange(group, value).withColumn("_part", F.spark_partition_id()), "running"
    )
    totals = staged.groupBy(group, "_part").agg(F.sum(amount).alias("_sum"))
    # Partition totals: one row per partition and group bordering it.
    w_parts = Window.partitionBy(group).orderBy("_part")
    offsets = totals.select(group, "_part", (F.sum("_sum").over(w_parts) - F.col("_sum")).alias("_offset"))
    w_inside = Window.partitionBy(group, "_part").orderBy(value)
    return (
        staged.withColumn("_inside", F.sum(amount).over(w_inside) - F.col(amount))
        .join(_keyed(offsets, [group, "_part"]), _matches([group, "_part"]), "inner")
        .select(*counts.columns, (F.col("_inside") + F.col("_offset")).alias(before))
    )


def partition_unique_id(df: DataFrame, name: str = "index") -> DataFrame:
    """Unique but not dense row id. It moves when partitions do: use it within one written result only."""
    return df.withColumn(name, F.monotonically_increasing_id())
