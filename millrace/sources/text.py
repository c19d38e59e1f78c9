"""Scans of delimited text and the row parsers over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import split_fields, to_number


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """CSV scan. The header is dropped from every file, not only the first.

    Without a schema the types are inferred, which reads the data once more.
    """
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column `value`."""
    return spark.read.text(path)


def parse_edges(lines: DataFrame, lenient: bool = False, names: bool = False) -> DataFrame:
    """`a,b,...` -> (src, dst); further fields are ignored. Ids are numbers, or
    text if `names`."""
    fields = split_fields(F.col("value"))
    pick = F.get if lenient else (lambda a, i: F.element_at(a, i + 1))
    column = lambda i: pick(fields, i) if names else to_number(pick(fields, i), "bigint", lenient)
    return lines.select(column(0).alias("src"), column(1).alias("dst"))


def parse_adjacency(
    lines: DataFrame, drop_last: bool = False, lenient: bool = False, names: bool = False
) -> DataFrame:
    """`id,n1,n2,...` -> (node, neighbours). Ids are numbers, or text if `names`.

    `drop_last` leaves out the last neighbour of every row. Bad text is an error;
    if lenient, a bad id is NULL and bad neighbours are left out.
    """
    fields = split_fields(F.col("value"))
    count = F.greatest(F.size(fields) - (2 if drop_last else 1), F.lit(0))
    node = F.get(fields, 0) if lenient else F.element_at(fields, 1)
    ids = F.slice(fields, F.lit(2), count)
    if not names:
        node = to_number(node, "bigint", lenient)
        ids = F.array_compact(F.transform(ids, lambda x: to_number(x, "bigint", True))) if lenient else ids.cast("array<bigint>")
    return lines.select(node.alias("node"), ids.alias("neighbours"))


def parse_points(
    lines: DataFrame,
    coords: Mapping[str, int] | None = None,
    label: tuple[str, int] | None = ("label", 0),
    lenient: bool = False,
) -> DataFrame:
    """Fields by position to double coordinates, with one field as text label."""
    coords = coords or {"x": 1, "y": 2, "z": 3, "w": 4}
    fields = split_fields(F.col("value"))
    pick = F.get if lenient else (lambda a, i: F.element_at(a, i + 1))
    columns = [pick(fields, label[1]).alias(label[0])] if label else []
    columns += [
        to_number(pick(fields, at), "double", lenient).alias(name)
        for name, at in coords.items()
    ]
    return lines.select(*columns)
