"""Graphs whose nodes have names: a dictionary from names to dense numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.operators.ordering import running_totals
from millrace.sources.scratch import scratch_path


def id_dictionary(names: DataFrame, column: str = "name") -> DataFrame:
    """(name, id): the distinct names numbered from 0 in their order, without gaps.

    The dictionary is a written table that grows with the names: it is joined by
    shuffles and never held by one task.
    """
    distinct = names.select(F.col(column).alias("name")).where(F.col("name").isNotNull()).distinct()
    numbered = running_totals(distinct, [F.asc("name")], [])
    path = scratch_path(names.sparkSession, "dictionary")
    numbered.select("name", (F.col("position") - 1).cast("bigint").alias("id")).write.parquet(path)
    return names.sparkSession.read.schema("name string, id bigint").parquet(path)


def replace_by(rows: DataFrame, column: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """`column` replaced by the `value` of the table row with that `key`; NULL stays
    NULL. Columns keep their order."""
    found = table.select(F.col(key).alias("_key"), F.col(value).alias("_value")).hint("merge")
    return rows.join(found, F.col(column) == F.col("_key"), "left").select(
        *[F.col("_value").alias(c) if c == column else F.col(c) for c in rows.columns]
    )


@dataclass
class NamedGraph:
    """Edges between numbers, and the dictionary of the names they stand for."""

    edges: DataFrame
    names: DataFrame

    def id_of(self, name: str) -> int | None:
        found = self.names.where(F.col("name") == name).first()
        return None if found is None else found.id

    def named(self, rows: DataFrame, *columns: str) -> DataFrame:
        """`rows` with names instead of the numbers in these columns."""
        for column in columns:
            rows = replace_by(rows, column, self.names, "id", "name")
        return rows

    def adjacency(self) -> DataFrame:
        """(node, neighbours) by name, sorted, one row per source."""
        pairs = self.named(self.edges, "src", "dst")
        return graph.adjacency_list(pairs)

    def distances_from(self, start: str, max_rounds: int | None = None) -> DataFrame:
        """(node, distance) of every node by name; all NULL if the start is unknown."""
        number = self.id_of(start)
        if number is None:
            nodes = self.names.select(F.col("name").alias("node"))
            return nodes.withColumn("distance", F.lit(None).cast("int"))
        return self.named(graph.distances_from(self.edges, number, max_rounds), "node")

    def degree_of_separation(self, start: str, target: str, max_rounds: int | None = None) -> DataFrame:
        """One row (start, target, degree, directions, gave_up) by name; a name that
        is unknown is not reached."""
        ids = [self.id_of(name) for name in (start, target)]
        facts = self.edges.sparkSession.createDataFrame(
            [(None, 0, False)], "degree int, directions bigint, gave_up boolean"
        )
        if None not in ids:
            facts = graph.degree_of_separation(self.edges, *ids, max_rounds).drop("start", "target")
        return facts.select(F.lit(start).alias("start"), F.lit(target).alias("target"), "*")


def named_graph(edges: DataFrame) -> NamedGraph:
    """Edges (src, dst) between names of any kind, numbered. A NULL destination
    stays NULL, a NULL source is dropped."""
    edges = edges.where(F.col("src").isNotNull()).select(
        F.col("src").cast("string"), F.col("dst").cast("string")
    )
    names = id_dictionary(edges.select(F.col("src").alias("name")).union(edges.select("dst")))
    numbered = edges
    for column in ("src", "dst"):
        numbered = replace_by(numbered, column, names, "name", "id")
    path = scratch_path(edges.sparkSession, "numbered-edges")
    numbered.write.parquet(path)
    return NamedGraph(edges.sparkSession.read.schema("src bigint, dst bigint").parquet(path), names)
