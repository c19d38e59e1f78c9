"""Finding and splitting keys that hold too many rows for one task."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_PARTITION = 4_000_000
# Up to here a table counts as small: shuffling it again costs next to nothing.
SMALL_ROWS = 1_000_000
SMALL_PARTITION = 50_000
# 12 MB of keys and block counts.
BROADCAST_KEYS = 1_000_000
# No key is split below this many rows.
BLOCK_ROWS = 100_000


@dataclass(frozen=True)
class KeyProfile:
    """Row totals of a key column and the keys that must be split.

    `hot` has one (key, blocks) pair per key with more than `block_rows` rows.
    As `block_rows >= rows / (4 * partitions)`, it has at most 4 * partitions
    entries: one per million rows of a large table, 12 bytes each. Up to
    `BROADCAST_KEYS` of them are broadcast, more are joined by a shuffle.
    """

    rows: int
    partitions: int
    block_rows: int
    hot: tuple[tuple[int, int], ...]


def partitions_for(df: DataFrame, rows: int) -> int:
    """Partition count for a table that is joined again and again.

    A large table gets at least `spark.sql.shuffle.partitions`: with fewer, the
    planner prefers to shuffle both sides of a join to that number.
    """
    spark = df.sparkSession
    if rows <= SMALL_ROWS:
        cores = spark.sparkContext.defaultParallelism
        return max(1, min(cores, math.ceil(rows / SMALL_PARTITION)))
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, math.ceil(rows / ROWS_PER_PARTITION))


def profile_key(df: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> KeyProfile:
    """Count rows per key (combined map-side) and list the hot keys."""
    per_key = df.groupBy(key).count()
    totals = per_key.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("count"), F.lit(0)).alias("largest"),
    ).first()
    partitions = partitions_for(df, totals.rows)
    limit = max(block_rows, math.ceil(totals.rows / (4 * partitions)))
    hot: tuple[tuple[int, int], ...] = ()
    if totals.largest > limit:
        found = per_key.where(F.col("count") > limit).collect()
        hot = tuple((r[key], math.ceil(r["count"] / limit)) for r in found)
    return KeyProfile(totals.rows, partitions, limit, hot)


def with_blocks(df: DataFrame, key: str, profile: KeyProfile) -> DataFrame:
    """Add `blocks`: how many blocks the key of this row is split into."""
    if not profile.hot:
        return df.withColumn("blocks", F.lit(1))
    hot = df.sparkSession.createDataFrame(
        list(profile.hot), "_hot_key bigint, _hot_blocks int"
    )
    if len(profile.hot) <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    return (
        df.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("blocks", F.coalesce("_hot_blocks", F.lit(1)))
        .drop("_hot_key", "_hot_blocks")
    )


def block_of(*spread: str) -> Column:
    """Block of a row among its key's `blocks`, spread by the given columns."""
    return F.when(F.col("blocks") == 1, 0).otherwise(
        F.pmod(F.xxhash64(*spread), F.col("blocks")).cast("int")
    )
