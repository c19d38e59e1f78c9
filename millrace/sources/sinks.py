"""Distributed text sinks and the schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adjacency_lines(adjacency: DataFrame) -> DataFrame:
    """(node, neighbours) -> one `id,n1,n2,...` line per row, column `value`."""
    ids = F.concat(F.array("node"), "neighbours").cast("array<string>")
    return adjacency.select(F.array_join(ids, ",").alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def write_adjacency(adjacency: DataFrame, path: str) -> None:
    write_lines(adjacency_lines(adjacency), path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.option("header", header).csv(path)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type, nulls), one row per column, in one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(df.schema)],
    )
    facts = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*facts)))
