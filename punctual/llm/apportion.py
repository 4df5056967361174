"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Targets: all tokens are shared by weight; a source stops at ``max_repeats`` times its size and the excess is
   shared again. Sorted by cap per weight, the sources that stop are a prefix, so running sums settle it at once.
2. Seats: the blocks of ``block_tokens`` in all tokens go to sources by highest quotient target / (2k + 1). Each
   source first gets the seats that it has for certain; only the last few are ranked, so that seats are never listed.
3. Each source is cut into shards by a hash of the row (``shard_rows`` rows each at most on average, so a hot source has many),
   and its seats go to its shards by the same rule over their sizes: integer quotas.
4. In a shard, rows are laid end to end in a seeded order and cut into blocks. Every block is taken as often as the
   quota allows for all of them, and the rest of the quota takes blocks evenly spread from a seeded start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import NOT_SPACE, text_or_empty
from punctual.staging import stage

SEED = 20
BLOCK_TOKENS = 64
SHARD_ROWS = 4_000
MAX_REPEATS = 3
#: Seats below the exact share which a source surely gets, and those above which it may still get.
SURE, MORE = 2, 5


def word_count(text: Column) -> Column:
    """Number of words, by the number of ends of words."""
    return F.regexp_count(text, F.lit(f"{NOT_SPACE}+")).cast("long")


def seeded(seed: int, *columns: Column) -> Column:
    """Uniform number in [0, 2^32) of a seed and columns."""
    parts = F.concat_ws("-", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(parts), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``weight`` (1, 2, 3 by code point of the source, null last), ``target_top`` / ``target_bottom`` and ``target``.

    One row per source comes in, with ``source_size``.
    """
    all_rows = Window.partitionBy(F.lit(0))
    by_name = all_rows.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    named = sources.withColumns({
        "place": F.row_number().over(by_name).cast("long"),
        "cap": F.col("source_size") * max_repeats,
        "total": F.sum("source_size").over(all_rows),
    }).withColumn("weight", (F.col("place") - 1) % 3 + 1)
    by_ratio = all_rows.orderBy("ratio", "place")
    ranked = named.withColumn("ratio", F.expr("cap * 6 div weight")).withColumns({
        "caps_before": F.sum("cap").over(by_ratio) - F.col("cap"),
        "weights_left": F.sum("weight").over(all_rows) - F.sum("weight").over(by_ratio) + F.col("weight"),
    })
    stops = F.col("weight") * (F.col("total") - F.col("caps_before")) >= F.col("cap") * F.col("weights_left")
    settled = ranked.withColumn("stops", stops).withColumns({
        "left": F.col("total") - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(all_rows),
        "weights": F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(all_rows),
    })
    top = F.when(F.col("stops"), F.col("cap")).otherwise(F.col("weight") * F.col("left"))
    bottom = F.when(F.col("stops"), F.lit(1)).otherwise(F.col("weights")).cast("long")
    return settled.withColumns({"target_top": top, "target_bottom": bottom}).withColumn(
        "target", F.col("target_top").cast("double") / F.col("target_bottom").cast("double")
    ).select("source", "source_size", "source_rows", "place", "target", "total")


def seats(df: DataFrame, group: list[str], votes: str, number: str, order: str, name: str) -> DataFrame:
    """Sainte-Lague seats: of each group, ``number`` seats go to its rows by highest votes / (2k + 1).

    Ties take the smaller ``order``. Rows without votes get none.
    """
    g = Window.partitionBy(*group)
    sure = df.withColumn("_share", F.when(F.sum(votes).over(g) > 0, F.col(number) * F.col(votes) / F.sum(votes).over(g)).otherwise(0.0)) \
        .withColumn("_sure", F.greatest(F.floor("_share") - SURE, F.lit(0)).cast("long"))
    left = sure.withColumn("_left", F.col(number) - F.sum("_sure").over(g))
    next_seats = left.select(
        *group, order, "_left", (F.col(votes) > 0).alias("_may"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(SURE + MORE)), lambda k: F.col(votes) / (2 * (F.col("_sure") + k) + 1))).alias("_k", "_quotient"),
    ).filter("_may")
    ranked = next_seats.withColumn("_rank", F.row_number().over(g.orderBy(F.desc("_quotient"), order, "_k"))) \
        .filter(F.col("_rank") <= F.col("_left")).groupBy(*group, order).agg(F.count(F.lit(1)).alias("_won"))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, order]]
    joined = left.alias("l").join(ranked.alias("r"), on, "left")
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias(name))


def _taken_before(x: Column, block: int) -> Column:
    """Tokens of the selected blocks before token ``x`` of the shard: ``extra`` of ``blocks`` blocks, from ``start`` on."""
    j = F.floor(x / block).cast("long")

    def chosen(i: Column) -> Column:
        return F.call_function("div", (i + F.col("start")) * F.col("extra"), F.col("blocks")).cast("long")

    return (chosen(j) - chosen(F.lit(0))) * block + (chosen(j + 1) - chosen(j)) * (x - j * block)


def mix(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", carry: Column | None = None,
    block_tokens: int = BLOCK_TOKENS, shard_rows: int = SHARD_ROWS, seed: int = SEED, max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (and ``carry`` as ``row``, any column of the caller's).

    A null or empty text has size 0 and nothing is taken. A null source is a source of its own, ordered last.
    Order inside a shard is (seeded hash, id, size): rows tied in all of them are alike, so reruns agree. No row is
    taken more than ``max_repeats`` times its size. Other columns are not looked at.
    """
    # Written: words are counted once, and three passes follow.
    sized = stage(df.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{source_column}`").cast("string").alias("source"),
        word_count(text_or_empty(text_column)).alias("size"), *([carry.alias("row")] if carry is not None else []),
    ), "mix-sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    wanted = targets(by_source, max_repeats).withColumns({
        "all": F.lit(0), "seats_in_all": F.expr(f"total div {block_tokens}"), "shards": F.expr(f"source_rows div {shard_rows} + 1"),
    })
    # Written, so that Spark knows their size and broadcasts them only where it is small.
    quota = stage(
        seats(wanted, ["all"], "target", "seats_in_all", "place", "seats").select("source", "source_size", "target", "place", "shards", "seats"),
        "mix-sources",
    )
    placed = _attach(sized, quota, ["source"], ["source_size", "target", "place", "shards"]).withColumn(
        "key", seeded(seed, F.col("doc_id"))).withColumn("shard", F.col("key") % F.col("shards"))
    shard_sizes = placed.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"))
    shards = seats(
        shard_sizes.join(quota.select("place", "seats"), "place"), ["place"], "shard_size", "seats", "shard", "quota"
    )
    shards = shards.withColumn("blocks", F.greatest(F.expr(f"(shard_size + {block_tokens - 1}) div {block_tokens}"), F.lit(1))).withColumns({
        "quota": F.least(F.col("quota"), F.col("blocks") * max_repeats),
        "start": seeded(seed + 1, F.col("place"), F.col("shard")) % F.col("blocks"),
    }).withColumns({"passes": F.expr("quota div blocks"), "extra": F.expr("quota % blocks")})
    shards = stage(shards.select("place", "shard", "passes", "extra", "blocks", "start"), "mix-shards")
    order = Window.partitionBy("place", "shard").orderBy("key", "doc_id", "size")
    laid = placed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = _attach(laid, shards, ["place", "shard"], ["passes", "extra", "blocks", "start"])
    taken = F.col("passes") * F.col("size") + _taken_before(F.col("end"), block_tokens) - _taken_before(F.col("end") - F.col("size"), block_tokens)
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(["row"] if carry is not None else []))


def _attach(rows: DataFrame, small: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left join on a null-safe key of a table with one row per key; Spark picks the join by measured size and splits skew."""
    right = small.select(*[F.col(c).alias(f"_{c}") for c in on], *columns)
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return rows.join(right, match, "left").select(*rows.columns, *columns)


def copies(size: Column, taken: Column, seed: int, *key: Column) -> Column:
    """Whole copies of a document for its taken words: the fraction is rounded up with its own probability, by a seeded hash."""
    whole = F.floor(taken / size)
    part = (taken % size) / size
    return F.when(size > 0, whole + F.when(seeded(seed, *key) < part * F.lit(float(1 << 32)), 1).otherwise(0)).otherwise(0).cast("int")


def mixed_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns that came in."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    chosen = mix(df, id_column, text_column, source_column, carry=row, seed=seed)
    times = chosen.withColumn("n", copies(F.col("size"), F.col("taken"), seed + 2, F.col("doc_id")))
    return times.filter("n > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
