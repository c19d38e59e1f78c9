"""Holding a DataFrame in the cache for the length of a job."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 50_000


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Cache on memory and local disk inside the block; a caller's own cache of
    the same DataFrame is left alone."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def in_few_tasks(held: DataFrame) -> DataFrame:
    """A cached DataFrame in no more tasks than its rows need, for loops whose
    rounds would otherwise be spent starting tasks. No shuffle; answers must not
    depend on how rows lie in the tasks (see placed_by_content)."""
    return held.coalesce(max(1, math.ceil(held.count() / ROWS_PER_TASK)))


def placed_by_content(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows placed and sorted by the hash of some columns: the same layout on
    every machine, for estimators that draw rows by partition."""
    mark = F.xxhash64(*columns)
    parts = max(1, math.ceil(df.count() / ROWS_PER_TASK))
    return df.withColumn("_mark", mark).repartition(parts, "_mark").sortWithinPartitions("_mark").drop("_mark")
