"""Lines that cannot be parsed, told apart from those that can."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import split_fields, to_number


@dataclass(frozen=True)
class Field:
    """A column at a position of the line, with its type."""

    name: str
    at: int
    dtype: str = "string"


@dataclass
class Checked:
    """`good` has the columns of the fields. `bad` has (reason, value, file, line)."""

    good: DataFrame
    bad: DataFrame


def read_located_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line: `value`, and where it lies: the file, the block of the file
    that a task reads, and a number that rises by one per line of the block."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def check_fields(located: DataFrame, fields: Sequence[Field], sep: str = ",") -> Checked:
    """Parse lines into typed columns; a line with a missing or bad field goes to
    quarantine with the first reason, its file and its line in it, from 1.

    Lines are numbered by counting those of the blocks before, so good lines are
    never shuffled. Further fields are ignored.
    """
    parts = split_fields(F.col("value"), sep)
    reasons, columns = [], []
    for f in fields:
        text = F.get(parts, f.at)
        columns.append(to_number(text, f.dtype, lenient=True).alias(f.name))
        reasons.append(F.when(text.isNull(), F.lit(f"no field {f.at}")))
        if f.dtype != "string":
            reasons.append(F.when(text.try_cast(f.dtype).isNull(), F.lit(f"field {f.at} is no {f.dtype}")))
    rows = located.withColumn("_reason", F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))
    good = rows.where(F.col("_reason").isNull()).select(*columns)
    blocks = located.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    bad = (
        rows.where(F.col("_reason").isNotNull())
        .join(offsets, ["_file", "_block"])
        .select(
            F.col("_reason").alias("reason"),
            "value",
            F.col("_file").alias("file"),
            (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("line"),
        )
    )
    return Checked(good, bad)
