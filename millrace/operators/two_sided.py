"""Pair queries by a search from both ends."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import EdgeStore, answer, edge_store
from millrace.operators.skew import BLOCK_ROWS
from millrace.sources.scratch import scratch_path

_LEVEL = "node bigint, copies bigint"


@dataclass
class Side:
    """The levels of a search from one end, a written table each. `copies` counts
    the edges that a node of the level is reached by from the level before."""

    spark: SparkSession
    store: EdgeStore
    base: str
    paths: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return len(self.paths) - 1

    def level(self, depth: int) -> DataFrame:
        return self.spark.read.schema(_LEVEL).parquet(self.paths[depth])

    def add(self, rows: DataFrame) -> None:
        path = f"{self.base}/level={len(self.paths):06d}"
        rows.write.parquet(path)
        self.paths.append(path)
        self.sizes.append(self.level(self.depth).count())

    def new(self, rows: DataFrame, first: int) -> DataFrame:
        """The rows whose node is in no level from `first` on."""
        if not self.paths[first:]:
            return rows
        seen = self.spark.read.schema(_LEVEL).parquet(*self.paths[first:])
        return rows.join(seen.select("node"), "node", "left_anti")

    def step(self, rows: DataFrame) -> DataFrame:
        """(node, copies) at the other end of the edges of these nodes."""
        return (
            self.store.expand(rows).groupBy(F.col("dst").alias("node")).agg(F.sum("copies").alias("copies"))
        )


@dataclass
class Meeting:
    degree: int | None
    directions: int
    gave_up: bool
    forward: Side
    backward: Side


def meet(ahead: EdgeStore, back: EdgeStore, start: int, target: int, max_rounds: int | None = None) -> Meeting:
    """Search forward from `start` and backward from `target`, always expanding the
    side whose last level has fewer nodes, until a level of one side holds nodes
    of the last level of the other.

    `ahead` holds the edges by source, `back` the same edges turned round. The
    target counts as reached by an edge into it only, so start and target may be
    the same. Levels that met before would have ended the search, so a new level can
    meet the last level of the other side alone: the sum of both depths is the
    degree.
    """
    spark = ahead.edges.sparkSession
    base = scratch_path(spark, "two-sided")
    one = lambda node: spark.range(node, node + 1, 1, 1).select(
        F.col("id").alias("node"), F.lit(1).cast("bigint").alias("copies")
    )
    forward, backward = Side(spark, ahead, f"{base}/forward"), Side(spark, back, f"{base}/backward")
    forward.add(one(start))
    backward.add(one(target))
    while forward.sizes[-1] and backward.sizes[-1]:
        if max_rounds is not None and forward.depth + backward.depth >= max_rounds:
            return Meeting(None, 0, True, forward, backward)
        grow, other = (forward, backward) if forward.sizes[-1] <= backward.sizes[-1] else (backward, forward)
        found = grow.step(grow.level(grow.depth))
        if grow is backward:
            # Level 0 is the target as an end, which is no node on the way.
            grow.add(grow.new(found, 1))
        elif backward.depth:
            grow.add(grow.new(found, 0))
        else:
            into = found.where(F.col("node") == target)
            grow.add(grow.new(found.where(F.col("node") != target), 0).unionByName(into))
        if grow is backward or backward.depth:
            met = forward.level(forward.depth).join(backward.level(backward.depth).select("node"), "node", "left_semi")
        else:
            met = forward.level(forward.depth).where(F.col("node") == target)
        if not met.isEmpty():
            degree = forward.depth + backward.depth
            return Meeting(degree, _directions(forward, backward, met, target), False, forward, backward)
    return Meeting(None, 0, False, forward, backward)


def _directions(forward: Side, backward: Side, met: DataFrame, target: int) -> int:
    """Edges into the target from nodes on a shortest way: from where the sides met,
    along the backward levels, to the level next to the target."""
    if not backward.depth:
        return met.first().copies
    nodes = met.select("node")
    for depth in range(backward.depth - 1, 0, -1):
        path = f"{backward.base}/way={depth:06d}"
        forward.step(nodes).join(backward.level(depth).select("node"), "node", "left_semi").select("node").write.parquet(path)
        nodes = forward.spark.read.schema("node bigint").parquet(path)
    return backward.level(1).join(nodes, "node", "left_semi").agg(F.sum("copies").alias("n")).first().n


def degree_of_separation(
    edges: DataFrame, start: int, target: int, max_rounds: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row (start, target, degree, directions, gave_up), as the one-sided search
    answers, from fewer edges where both ends have few neighbours."""
    turned = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    with edge_store(edges, block_rows) as ahead, edge_store(turned, block_rows) as back:
        found = meet(ahead, back, start, target, max_rounds)
    return answer(edges.sparkSession, start, target, found.degree, found.directions, found.gave_up)
