"""Column functions for reproducible sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of a key, from the first 32 bits of its md5.

    Depends on the key alone, so every run, partitioning and engine agrees.
    """
    digits = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
