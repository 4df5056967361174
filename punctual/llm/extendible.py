"""Sharding by extendible hashing.

A row's hash bits lead through a directory to its bucket. A bucket beyond the byte limit splits on its next bit, and only
that one, until every bucket fits. Sizes per slot of ``ROUND_BITS`` bits are summed once and rolled up level by
level; slots still too large go on with their next bits. Rows whose hashes are equal to the last bit can't be split
by it: their bucket gets overflow pages of its own, each within the limit, filled by running sizes per written
partition, so that no task holds them all. A single row beyond the limit is a page of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.staging import stage

LIMIT_BYTES = 8 << 20
ROUND_BITS = 15
HASH_BITS = 60


def portable_hash(*columns: Column) -> Column:
    """60 bits of the MD5 of the columns as text."""
    text = F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets (depth, prefix, shard_bytes, shard_rows) of rows with ``h`` and ``bytes``. Depth ``HASH_BITS`` may be beyond the limit."""
    waiting, buckets, done = rows.select("h", "bytes"), None, 0
    while True:
        last = done + ROUND_BITS >= HASH_BITS
        slots = stage(
            waiting.groupBy(F.shiftright("h", HASH_BITS - done - ROUND_BITS).alias("slot"))
            .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-slots",
        )
        # Every slot lies in one bucket per depth; the bucket is the shallowest that fits below one that doesn't.
        depths = F.sequence(F.lit(done if done == 0 else done + 1), F.lit(done + ROUND_BITS))
        levels = slots.select(F.explode(depths).alias("depth"), "slot", "bytes", "rows").withColumn(
            "prefix", F.expr(f"shiftright(slot, cast({done + ROUND_BITS} - depth as int))")
        ).groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        levels = stage(levels, "shard-levels")
        too_large = levels.filter(F.col("shard_bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        below = levels.withColumn("parent", F.shiftright("prefix", 1)).join(too_large, ["depth", "parent"], "left_semi").drop("parent")
        first = levels.filter(F.col("depth") == (0 if done == 0 else done + 1))
        if done:
            below = below.filter(F.col("depth") > done + 1).unionByName(first)  # their parents were too large in the last round
        else:
            below = below.unionByName(first)
        fits = below.filter((F.col("shard_bytes") <= limit) | F.lit(last) & (F.col("depth") == HASH_BITS))
        fits = fits.select("depth", "prefix", "shard_bytes", "shard_rows")
        buckets = fits if buckets is None else buckets.unionByName(fits)
        over = levels.filter((F.col("depth") == done + ROUND_BITS) & (F.col("shard_bytes") > limit)).select(F.col("prefix").alias("_over"))
        if last or over.isEmpty():
            return stage(buckets, "shard-buckets")
        done += ROUND_BITS
        waiting = waiting.join(over, F.shiftright("h", HASH_BITS - done) == F.col("_over"), "left_semi")


def shards(df: DataFrame, key: list[Column], size: Column, limit: int = LIMIT_BYTES) -> DataFrame:
    """The rows of ``df`` as ``row``, with shard (bits of the prefix, then page), depth, shard_bytes, shard_rows.

    ``key`` gives the hash (nulls count as empty), ``size`` the bytes of a row (null: 0). Repeated rows share a hash; pages
    keep them within the limit too. An empty table has no rows and no shards.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("row"), portable_hash(*key).alias("h"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"))
    buckets = directory(rows, limit)
    # The directory: one entry per bucket, found by the prefix at its depth. Depths are few, so each row looks once at each.
    depths = sorted(r.depth for r in buckets.select("depth").distinct().collect())
    if not depths:
        return rows.select("row", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard_bytes"),
                           F.lit(0).cast("long").alias("shard_rows"))
    entries = buckets.select(F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"), "depth", "prefix", "shard_bytes", "shard_rows")
    looks = F.explode(F.array(*[F.struct(F.lit(d).alias("_depth"), F.shiftright("h", HASH_BITS - d).alias("_prefix")) for d in depths]))
    found = rows.select("row", "h", "bytes", looks.alias("look")).select("row", "h", "bytes", "look.*").join(entries, ["_depth", "_prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(bin(prefix), 64, '0'), depth)"))
    plain = found.filter((F.col("depth") < HASH_BITS) | (F.col("shard_bytes") <= limit)).select(
        "row", bits.alias("shard"), "depth", "shard_bytes", "shard_rows")
    crowded = buckets.filter((F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit))
    if crowded.isEmpty():
        return plain
    return plain.unionByName(_pages(found.filter((F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit)), bits, limit))


def _pages(found: DataFrame, bits: Column, limit: int) -> DataFrame:
    """Overflow pages of rows with equal hashes: per written partition, a row opens a page when the running size passes the limit.

    Rows of a page start within half the limit; a row larger than that is a page of its own.
    """
    frozen = stage(found.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "shard-crowded")
    half = max(1, limit // 2)
    running = Window.partitionBy("h", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.when(F.col("bytes") <= half, F.col("bytes")).otherwise(0)).over(running), F.lit(0))
    page = F.when(F.col("bytes") > half, F.concat_ws("-", F.lit("row"), "part", "at")).otherwise(
        F.concat_ws("-", F.col("part"), F.floor(start / half)))
    paged = stage(frozen.withColumn("page", page), "shard-pages")
    sizes = paged.groupBy("h", "page").agg(F.sum("bytes").alias("page_bytes"), F.count(F.lit(1)).alias("page_rows"))
    return paged.join(sizes, ["h", "page"]).select(
        "row", F.concat(bits, F.lit("+"), "page").alias("shard"), "depth", F.col("page_bytes").alias("shard_bytes"), F.col("page_rows").alias("shard_rows"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard as one folder; a task gets whole shards, each within the limit."""
    sharded.repartition("shard").select("shard", "row.*").write.partitionBy("shard").mode("errorifexists").parquet(path)
