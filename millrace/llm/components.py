"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import scratch_path


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links` (a, b); a component is named by
    its smallest id. Self links and repeated links change nothing.

    Each round renames every vertex to its smallest neighbour, or itself, and
    contracts the links; what is left shrinks by about half a round. Tables are
    written between the rounds. Minima are combined before they are shuffled, so
    a vertex with very many links is no hot key there.
    """
    edges = links.select("a", "b").where("a <> b").distinct()
    names = None
    while True:
        edges = _stored(edges, "links")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = _stored(
            both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "names"
        )
        if names is None:
            names = step.select(F.col("a").alias("id"), F.col("to").alias("component"))
        else:
            names = names.join(step, names.component == step.a, "left").select(
                "id", F.coalesce("to", "component").alias("component")
            )
        names = _stored(names, "components")
        left = step.select(F.col("a").alias("_a"), F.col("to").alias("_to_a"))
        right = step.select(F.col("a").alias("_b"), F.col("to").alias("_to_b"))
        edges = (
            edges.join(left, F.col("a") == F.col("_a"))
            .join(right, F.col("b") == F.col("_b"))
            .where("_to_a <> _to_b")
            .select(F.least("_to_a", "_to_b").alias("a"), F.greatest("_to_a", "_to_b").alias("b"))
            .distinct()
        )
        if edges.isEmpty():
            return names
