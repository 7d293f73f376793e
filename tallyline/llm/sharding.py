"""Shards of bounded size by extendible hashing.

A directory is indexed by the leading bits of a key's hash. All rows start in
one bucket; a bucket over the byte limit splits on its next bit, others stay.
The splitting runs on sums per hash prefix, so hot keys are pre-aggregated
before they are shuffled.

A key whose rows alone exceed the limit cannot be split by its own hash: its
bucket goes on with bits of a hash over the row's place, so a hot key spreads
over as many shards as its bytes need. A single row above the limit has a
shard of its own.

Null keys hash as the empty text and null sizes count as 0. No row is dropped,
repeated rows are rows like any other, an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, key_bits, land
from tallyline.session import union_all

HASH_BITS = 60
ROUND_BITS = 12
RESULT = ("shard", "shard_bytes", "shard_rows")


def _round(live: DataFrame, row: str, base: int, top: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Split buckets of depth ``base`` down to depth ``top`` at most.

    Returns the bins (stem and prefix of ``top`` bits) that found a bucket,
    with it, and the bins that are too large even at depth ``top``.
    """
    field = lambda name: F.col(f"{row}.{name}")
    sums = live.groupBy(field("stem").alias("stem"), F.shiftright(field("h"), HASH_BITS - top).alias("bin")).agg(
        F.sum(field("size")).alias("bytes"), F.count("*").alias("n"), F.min(field("h")).alias("lo"), F.max(field("h")).alias("hi")
    )
    sums = land(sums, "shard-sums")
    each = sums.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(top)))).withColumn(
        "prefix", F.expr(f"shiftright(bin, {top} - depth)")
    )
    buckets = each.groupBy("stem", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    # A bucket stops splitting at the first depth at which it fits or holds one row.
    fits = buckets.where((F.col("bytes") <= limit) | (F.col("n") == 1))
    bins = (
        each.select("stem", "bin", "depth", "prefix")
        .join(fits, ["stem", "depth", "prefix"])
        .groupBy("stem", "bin")
        .agg(F.min(F.struct("depth", "prefix", "bytes", "n")).alias("leaf"))
    )
    bins = land(bins, "shard-bins")
    return bins, sums.join(bins.select("stem", "bin"), ["stem", "bin"], "left_anti")


def assign_shards(df: DataFrame, key: str, size: Column, limit_bytes: int) -> DataFrame:
    """``df`` with ``shard`` (the bits that lead to it, '' if one shard does), ``shard_bytes`` and ``shard_rows``.

    Two rows of one key share a shard unless that key alone exceeds the limit.
    The columns of ``df`` are landed once; pass those you need. Columns that
    are called like a result are replaced.
    """
    own = [c for c in df.columns if c.lower() not in RESULT]
    row = free_name(df, "row")
    first = F.struct(
        F.lit("").alias("stem"),
        key_bits(F.col(key), HASH_BITS).alias("h"),
        key_bits(F.monotonically_increasing_id(), HASH_BITS).alias("place"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
    )
    live = land(df.select(*own, first.alias(row)), "shard-rows")
    total = live.agg(F.coalesce(F.sum(F.col(row + ".size")), F.lit(0))).first()[0]
    step = max(ROUND_BITS, math.ceil(math.log2(total / limit_bytes + 1)) + 4)

    found, work = [], [(live, 0, False)]
    while work:
        live, base, by_place = work.pop()
        top = min(base + step, HASH_BITS)
        bins, too_large = _round(live, row, base, top, limit_bytes)
        keyed = live.withColumn(row, F.col(row).withField("bin", F.shiftright(F.col(row + ".h"), HASH_BITS - top)))
        stem, at = free_name(live, "leaf_stem"), free_name(live, "leaf_bin")
        match = (F.col(row + ".stem") == F.col(stem)) & (F.col(row + ".bin") == F.col(at))
        path = F.concat("stem", F.when(F.col("leaf.depth") > 0, F.lpad(F.conv("leaf.prefix", 10, 2), F.col("leaf.depth"), F.lit("0"))).otherwise(""))
        leaves = bins.select(F.col("stem").alias(stem), F.col("bin").alias(at), path.alias("shard"), F.col("leaf.bytes").alias("shard_bytes"), F.col("leaf.n").alias("shard_rows"))
        found.append(keyed.join(leaves, match).select(*own, *RESULT))
        # A bucket of a single key goes on by the rows' places, others by further bits of the key.
        left = land(too_large, "shard-open")
        stuck = (left["lo"] == left["hi"]) if not by_place else F.lit(False)
        for part, places in ((left.where(~stuck), by_place), (left.where(stuck), True)):
            if not part.take(1):
                continue
            if top == HASH_BITS and places == by_place:
                raise RuntimeError(f"{HASH_BITS} bits of a row's hash do not tell its bucket's rows apart")
            rest = keyed.join(part.select(F.col("stem").alias(stem), F.col("bin").alias(at)), match, "left_semi")
            if places != by_place:
                whole = F.concat(F.lpad(F.conv(F.col(row + ".h"), 10, 2), HASH_BITS, "0"), F.lit("/"))
                moved = F.struct(whole.alias("stem"), F.col(row + ".place").alias("h"), F.col(row + ".place"), F.col(row + ".size"))
                rest = rest.withColumn(row, moved)
            work.append((land(rest, "shard-rest"), top if places == by_place else 0, places))
    return union_all(found)


def directory(sharded: DataFrame) -> DataFrame:
    """One row per shard: the bits it is found by, its depth, bytes and rows."""
    return sharded.select(*RESULT).distinct().withColumn("depth", F.length(F.regexp_replace("shard", "/", "")))
