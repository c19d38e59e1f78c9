"""Running totals in a global order, without a single task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.sources.scratch import scratch_path


def running_totals(rows: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Add `position` (from 1) and, for each summed column, its running total
    and overall total, `<name>_upto` and `<name>_all`.

    The order must be total. The rows are ranged over the partitions and written
    with their range number; totals per range then offset the running sums
    inside each range. Rows with equal order columns must be combined before, or
    they would meet in one range.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "ranges")
    rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    schema = StructType([*rows.schema.fields, StructField("_range", IntegerType())])
    ranged = spark.read.schema(schema).parquet(path)
    per_range = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in sums]
    )
    # At most one row per shuffle partition, so this window stays small and the
    # join below may be broadcast.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = per_range.select(
        "_range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before") for c in ("_rows", *sums)],
        *[F.sum(c).over(overall).alias(f"{c}_all") for c in sums],
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "_range").select(
        *[F.col(c) for c in rows.columns],
        (F.col("__rows_before") + F.count(F.lit(1)).over(within)).alias("position"),
        *[(F.col(f"_{c}_before") + F.sum(c).over(within)).alias(f"{c}_upto") for c in sums],
        *[F.col(f"{c}_all") for c in sums],
    )


def grouped_totals(
    rows: DataFrame, within: Sequence[str], order: Sequence[Column], sums: Sequence[str]
) -> DataFrame:
    """Add `position` (from 1) and `<name>_upto` for each summed column, counted
    anew for every group of `within`, whose order must be total.

    A group of any size may span several ranges. Only a range's first and last group
    can, so their totals per range, two rows each at most, are all that has to be
    known of other ranges.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "ranges")
    keys = [F.col(c) for c in within]
    rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    schema = StructType([*rows.schema.fields, StructField("_range", IntegerType())])
    ranged = spark.read.schema(schema).parquet(path)
    group = F.struct(*keys)
    ends = ranged.groupBy("_range").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    totals = ranged.groupBy("_range", *within).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in sums]
    )
    open_groups = totals.join(F.broadcast(ends), "_range").where(
        group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last"))
    )
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = open_groups.select(
        F.struct("_range", *within).alias("_at"),
        *[F.sum(c).over(before).alias(f"_{c}_before") for c in ("_rows", *sums)],
    )
    inside = Window.partitionBy("_range", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = lambda c: F.coalesce(f"_{c}_before", F.lit(0))
    return ranged.join(
        F.broadcast(offsets), F.struct("_range", *within).eqNullSafe(F.col("_at")), "left"
    ).select(
        *[F.col(c) for c in rows.columns],
        (known("_rows") + F.count(F.lit(1)).over(inside)).alias("position"),
        *[(known(c) + F.sum(c).over(inside)).alias(f"{c}_upto") for c in sums],
    )
