"""Projections, filters, samples and splits."""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import hash_bucket
from millrace.sources.scratch import scratch_path


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def with_label(
    df: DataFrame, target: str | Column, features: Sequence[str], label: str = "label"
) -> DataFrame:
    """The target renamed to `label`, then the feature columns."""
    column = F.col(f"`{target}`") if isinstance(target, str) else target
    return df.select(column.alias(label), *[F.col(f"`{c}`") for c in features])


def typed_pair(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """(prediction, label) as doubles."""
    return df.select(
        F.col(prediction).cast("double").alias("prediction"),
        F.col(label).cast("double").alias("label"),
    )


def drop_all_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every listed column is 0. NULL is not 0."""
    return df.where(~reduce(and_, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns]))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def head_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First n rows by a key: a top-n per partition, then a top-n of those."""
    return df.orderBy(*order_by).limit(n)


# --- samples ---------------------------------------------------------------

# Digits of a mark that one pass counts, so 65,536 counts at most.
MARK_DIGITS = 4
# Rows around the cut that are sorted instead of counted further.
CUT_ROWS = 100_000


def least_by_mark(df: DataFrame, n: int, mark: Column, ties: Sequence[str | Column] = ()) -> DataFrame:
    """Exactly the n rows with the least mark (all, if there are fewer), in no order.

    `mark` is text of md5's 32 digits. A pass counts the rows by the first digits and
    finds where the n-th row lies; rows before that are a filter. Passes go on
    inside the digits of the cut until few rows are left to sort, so no task sees
    the n rows, whatever n is. The input must give the same rows each time.
    """
    marked = df.withColumn("_mark", mark)
    prefix, left = "", n
    while True:
        width = len(prefix) + MARK_DIGITS
        counts = (
            marked.where(F.startswith("_mark", F.lit(prefix)))
            .groupBy(F.substring("_mark", 1, width).alias("_prefix"))
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        upto = F.sum("_rows").over(Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0))
        cut = counts.withColumn("_upto", upto).where(F.col("_upto") >= left).orderBy("_prefix").first()
        if cut is None:
            return df
        prefix, left = cut["_prefix"], left - (cut["_upto"] - cut["_rows"])
        if cut["_rows"] <= CUT_ROWS or width >= 32:
            break
    before = marked.where(F.col("_mark") < prefix)
    edge = marked.where(F.startswith("_mark", F.lit(prefix))).orderBy("_mark", *ties).limit(max(left, 0))
    return before.unionByName(edge).drop("_mark")


def _text(key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(column.cast("string"), F.lit(""))


def sample_by_hash(df: DataFrame, n: int, key: str) -> DataFrame:
    """Exactly n rows, the first in md5 order of a unique key: the same rows on
    every run."""
    return least_by_mark(df, n, F.md5(_text(key)), [key])


def with_random(
    df: DataFrame, seed: int, key: str | Column | None = None, column: str = "random"
) -> DataFrame:
    """`df` with a stored uniform number in [0, 1), from which samples and parts are
    filters: reading it again gives the same numbers.

    With a unique `key` the number is made of seed and key, so it is the same on
    every run and any number of cores.
    """
    if key is None:
        number = F.rand(seed)
    else:
        digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _text(key))), 1, 13)
        number = F.conv(digits, 16, 10).cast("bigint") / F.lit(2.0**52)
    path = scratch_path(df.sparkSession, "random")
    rows = df.withColumn(column, number)
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def sample_exact(df: DataFrame, n: int, seed: int | None = None, key: str | None = None) -> DataFrame:
    """Exactly n rows, uniform, without replacement (fewer if there are fewer). With
    a unique key, seed and key alone decide the sample."""
    seed = random.randrange(2**31) if seed is None else seed
    if key is not None:
        return least_by_mark(df, n, F.md5(F.concat(F.lit(f"{seed}:"), _text(key))), [key])
    stored = with_random(df, seed, None, "_random")
    return least_by_mark(stored, n, F.md5(F.col("_random").cast("string"))).drop("_random")


# --- splits ----------------------------------------------------------------


def parts_of(rows: DataFrame, weights: Sequence[float], column: str = "random") -> list[DataFrame]:
    """Filters on a stored random column: disjoint parts that cover all rows."""
    bounds = [sum(weights[:i]) / sum(weights) for i in range(1, len(weights))]
    at = F.col(column)
    return [
        rows.where((at >= low) & (at < high)).drop(column)
        for low, high in zip([0.0, *bounds], [*bounds, 2.0])
    ]


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 12345, key: str | Column | None = None
) -> list[DataFrame]:
    """Random parts. The numbers are stored once: the parts stay disjoint and cover
    all rows when they are computed again, and the input is read once."""
    return parts_of(with_random(df, seed, key, "_random"), weights, "_random")


def hash_split(
    df: DataFrame, key: str | Column, train_percent: int = 70
) -> tuple[DataFrame, DataFrame]:
    """Split by the md5 bucket of a key: a filter, the same on every run. Rows
    with a NULL key are in bucket 0."""
    column = F.col(key) if isinstance(key, str) else key
    bucket = F.coalesce(hash_bucket(column), F.lit(0))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)
