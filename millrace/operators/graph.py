"""Adjacency lists and breadth-first traversal of a directed edge list.

Edges are (src, dst), with a NULL dst for a source without edges, and never travel with the traversal state: a round moves
only the frontier and the ids it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import colour_of, colour_rank, rank_colour
from millrace.operators.ordering import grouped_totals
from millrace.operators.skew import (
    BLOCK_ROWS,
    KeyProfile,
    block_of,
    profile_key,
    with_blocks,
)
from millrace.sources.scratch import scratch_path

_REACHED = "node bigint, distance int, directions bigint"


# --- adjacency -------------------------------------------------------------


def _counted(edges: DataFrame) -> DataFrame:
    """Distinct edges with their number of copies (combined map-side)."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))


def adjacency_list(edges: DataFrame) -> DataFrame:
    """(node, neighbours), one row per source, sorted, duplicates kept.

    All neighbours of a node are one value; where a node may have more than that
    should hold, use `partitioned_adjacency`.
    """
    return edges.groupBy(F.col("src").alias("node")).agg(
        F.array_sort(F.collect_list("dst")).alias("neighbours")
    )


def partitioned_adjacency(edges: DataFrame, part_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, part, neighbours) for nodes of any degree: the sorted neighbours,
    duplicates kept, cut into parts of exactly `part_rows`; only a node's last part
    may be shorter. A source without neighbours has an empty part 0.

    Copies are counted before they move, and a node's places are numbered over as
    many ranges as it takes, so neither a large node nor many copies of one edge
    meet in a task.
    """
    placed = grouped_totals(
        _counted(edges.where(F.col("dst").isNotNull())), ["src"], [F.asc("dst")], ["copies"]
    )
    size = F.lit(part_rows).cast("bigint")
    first, end = F.col("copies_upto") - F.col("copies"), F.col("copies_upto")
    div = lambda a: F.floor(a / size)
    pieces = placed.withColumn("part", F.explode(F.sequence(div(first), div(end - 1))))
    here = F.least(end, (F.col("part") + 1) * size) - F.greatest(first, F.col("part") * size)
    parts = pieces.groupBy(F.col("src").alias("node"), "part").agg(
        F.array_sort(F.flatten(F.collect_list(F.array_repeat("dst", here.cast("int"))))).alias("neighbours")
    )
    alone = edges.groupBy(F.col("src").alias("node")).agg(F.count("dst").alias("n")).where("n = 0")
    none = F.array().cast(parts.schema["neighbours"].dataType)
    return parts.unionByName(
        alone.select("node", F.lit(0).cast("bigint").alias("part"), none.alias("neighbours"))
    )


def edges_of(adjacency: DataFrame) -> DataFrame:
    """(node, neighbours), with any number of rows per node -> (src, dst). A row
    without neighbours keeps one edge with a NULL destination, so that its node
    stays in the graph."""
    return adjacency.select(
        F.col("node").alias("src"), F.explode_outer("neighbours").alias("dst")
    )


def node_ids(edges: DataFrame) -> DataFrame:
    """Every id that occurs as source or destination."""
    return (
        edges.select(F.col("src").alias("node"))
        .union(edges.select("dst"))
        .where(F.col("node").isNotNull())
        .distinct()
    )


# --- steps over state tables -----------------------------------------------


def initial_state(edges: DataFrame, start: int) -> DataFrame:
    """(node, distance, colour): the start at 0 on the frontier, others unseen."""
    distance = F.when(F.col("node") == start, F.lit(0))
    return node_ids(edges).select(
        "node", distance.alias("distance"), colour_of(distance, 0).alias("colour")
    )


def expand_frontier(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """(src, node, distance): one row per out-edge of a frontier node.

    A hot source is split into blocks on both sides; its frontier row is repeated.
    """
    profile = profile_key(edges, "src")
    upto = F.sequence(F.lit(0), F.col("blocks") - 1)
    split = with_blocks(edges, "src", profile).withColumn("block", block_of("dst")).drop("blocks")
    return (
        with_blocks(frontier.select(F.col("node").alias("src"), "distance"), "src", profile)
        .withColumn("block", F.explode(upto))
        .drop("blocks")
        .join(split, ["src", "block"])
        .select("src", F.col("dst").alias("node"), (F.col("distance") + 1).alias("distance"))
    )


def unvisited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct candidates that were not reached before."""
    return (
        candidates.groupBy("node")
        .agg(F.min("distance").alias("distance"))
        .join(visited.select("node"), "node", "left_anti")
    )


def union_state(state: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each node's own row and the rows emitted for it, unmerged."""
    return state.unionByName(candidates)


def _merged_facts(rows: DataFrame) -> DataFrame:
    """(node, distance, colour): least distance, darkest colour."""
    return (
        rows.groupBy("node")
        .agg(
            F.min("distance").alias("distance"),
            F.max(colour_rank(F.col("colour"))).alias("_rank"),
        )
        .withColumn("colour", rank_colour(F.col("_rank")))
        .drop("_rank")
    )


def merge_state(rows: DataFrame) -> DataFrame:
    """Merge rows (node, neighbours, distance, colour) into one per node:
    neighbours concatenated (sorted), least distance, darkest colour."""
    edges = rows.select(F.col("node").alias("src"), F.explode_outer("neighbours").alias("dst"))
    return (
        _merged_facts(rows)
        .join(adjacency_list(edges), "node")
        .select("node", "neighbours", "distance", "colour")
    )


def merge_state_parts(rows: DataFrame, part_rows: int = BLOCK_ROWS) -> DataFrame:
    """The same for nodes of any degree, with the neighbours in parts: (node, part,
    neighbours, distance, colour)."""
    edges = rows.select(F.col("node").alias("src"), F.explode_outer("neighbours").alias("dst"))
    return (
        partitioned_adjacency(edges, part_rows)
        .join(_merged_facts(rows), "node")
        .select("node", "part", "neighbours", "distance", "colour")
    )


def target_hits(distances: DataFrame, edges: DataFrame, target: int) -> DataFrame:
    """(round, hits): frontier edges into the target in each round."""
    return (
        edges.where(F.col("dst") == target)
        .groupBy("src")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(distances.where(F.col("distance").isNotNull()), F.col("src") == F.col("node"))
        .groupBy((F.col("distance") + 1).alias("round"))
        .agg(F.sum("copies").alias("hits"))
    )


# --- traversal -------------------------------------------------------------


@dataclass
class EdgeStore:
    """Edges held for many frontier joins: partitioned and sorted by source, so
    a round shuffles its frontier but never the edges. A hot source is split
    into blocks, and its frontier row is repeated once per block."""

    edges: DataFrame
    profile: KeyProfile
    # Whether the edges are placed by (src, block) even without a hot source.
    by_block: bool = False

    def expand(self, frontier: DataFrame) -> DataFrame:
        """(dst, copies), one row per distinct out-edge of the frontier."""
        keyed = frontier.select(F.col("node").alias("src"))
        on = ["src"]
        if self.profile.hot or self.by_block:
            on = ["src", "block"]
            keyed = with_blocks(keyed, "src", self.profile).select(
                "src", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
            )
        return keyed.join(self.edges, on).select("dst", "copies")


@contextmanager
def edge_store(edges: DataFrame, block_rows: int = BLOCK_ROWS) -> Iterator[EdgeStore]:
    """Hold the edges for the duration of a traversal.

    They are derived once and written to the shared folder; the partitioned
    copy is cached on memory and local disk, and what a lost executor held of it
    is read from there again.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    ids = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint"))
    ids.where(F.col("dst").isNotNull()).write.parquet(path)
    table = spark.read.schema("src bigint, dst bigint").parquet(path)
    profile = profile_key(table, "src", block_rows)
    if profile.hot:
        keys = ["src", "block"]
        rows = with_blocks(_counted(table), "src", profile).select(
            "src", block_of("dst").alias("block"), "dst", "copies"
        )
    else:
        keys = ["src"]
        rows = table.withColumn("copies", F.lit(1).cast("bigint"))
    held = (
        rows.repartition(profile.partitions, *keys)
        .sortWithinPartitions(*keys)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # The planner knows the partitioning of a cached table only once it is filled.
    held.count()
    try:
        yield EdgeStore(held, profile)
    finally:
        held.unpersist()


@dataclass
class Traversal:
    """What a traversal reached: one written table per round."""

    spark: SparkSession
    paths: list[str] = field(default_factory=list)
    hit_round: int | None = None
    hits: int | None = None
    # Whether rounds ran out while there still was a frontier.
    gave_up: bool = False

    @property
    def reached(self) -> DataFrame:
        """(node, distance, directions) of every node reached so far."""
        return self.spark.read.schema(_REACHED).parquet(*self.paths)


def traverse(
    store: EdgeStore,
    start: int,
    target: int | None = None,
    max_rounds: int | None = None,
) -> Traversal:
    """Breadth-first rounds from `start`, until the target is hit, the frontier
    is empty or `max_rounds` is spent.

    Each round writes only the nodes it reaches first to the shared folder. That
    cuts the lineage, and a lost executor costs a round at most. The start is
    no hit by itself: it is hit when an edge leads back to it.
    """
    spark = store.edges.sparkSession
    base = scratch_path(spark, "traversal")
    walk = Traversal(spark)

    def add_round(rows: DataFrame) -> DataFrame:
        path = f"{base}/round={len(walk.paths):06d}"
        rows.write.parquet(path)
        walk.paths.append(path)
        return spark.read.schema(_REACHED).parquet(path)

    frontier = add_round(
        spark.range(start, start + 1, 1, 1).select(
            F.col("id").alias("node"),
            F.lit(0).alias("distance"),
            F.lit(0).cast("bigint").alias("directions"),
        )
    )
    number = 0
    while max_rounds is None or number < max_rounds:
        number += 1
        candidates = (
            store.expand(frontier)
            .groupBy(F.col("dst").alias("node"))
            .agg(F.sum("copies").alias("directions"))
        )
        seen = walk.reached.select("node")
        if target is not None:
            seen = seen.where(F.col("node") != target)
        frontier = add_round(
            candidates.join(seen, "node", "left_anti").select(
                "node", F.lit(number).alias("distance"), "directions"
            )
        )
        # The target's row if it was reached, else any row: one stage, one row.
        first = frontier.orderBy(F.coalesce(F.col("node") != F.lit(target), F.lit(True))).limit(1)
        found = first.collect()
        if not found:
            break
        if found[0].node == target:
            walk.hit_round, walk.hits = number, found[0].directions
            break
    else:
        walk.gave_up = True
    return walk


def degree_of_separation(
    edges: DataFrame,
    start: int,
    target: int,
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row (start, target, degree, directions, gave_up).

    `degree` is the first round with an edge from the frontier into the target,
    `directions` the number of such edges; NULL and 0 if there is none. `gave_up`
    tells a target not met within `max_rounds` from one that cannot be reached.
    """
    with edge_store(edges, block_rows) as store:
        walk = traverse(store, start, target, max_rounds)
    return answer(edges.sparkSession, start, target, walk.hit_round, walk.hits or 0, walk.gave_up)


def answer(
    spark: SparkSession, start: int, target: int, degree: int | None, directions: int, gave_up: bool
) -> DataFrame:
    return spark.createDataFrame(
        [(start, target, degree, directions, gave_up)],
        "start bigint, target bigint, degree int, directions bigint, gave_up boolean",
    )


def reached_from(
    edges: DataFrame,
    start: int,
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(node, distance) of the nodes within `max_rounds` hops of the start; nothing
    if the start is no node of the graph."""
    with edge_store(edges, block_rows) as store:
        walk = traverse(store, start, None, max_rounds)
    unknown = edges.where((F.col("src") == start) | (F.col("dst") == start)).isEmpty()
    reached = walk.reached.select("node", "distance")
    return reached.where(F.lit(not unknown))


def distances_from(
    edges: DataFrame,
    start: int,
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(node, distance) of every node: 0 at the start, NULL if unreached."""
    reached = reached_from(edges, start, max_rounds, block_rows)
    return node_ids(edges).join(reached, "node", "left")


def state_after(edges: DataFrame, start: int, rounds: int) -> DataFrame:
    """(node, distance, colour) of every node after a number of rounds."""
    return distances_from(edges, start, max_rounds=rounds).withColumn(
        "colour", colour_of(F.col("distance"), rounds)
    )


def progress(
    edges: DataFrame,
    start: int,
    target: int | None = None,
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(round, frontier_nodes, frontier_edges, processed) of every round run.

    `processed` is the rows of state (all sources and all ids reached before)
    plus the out-edges of the frontier.
    """
    with edge_store(edges, block_rows) as store:
        walk = traverse(store, start, target, max_rounds)
    # What the last round reached is no frontier that ran.
    last = len(walk.paths) - 1
    degrees = edges.groupBy("src").agg(F.count("dst").alias("out_edges"))
    reached = walk.reached.where(F.col("distance") < last)
    # Sources never reached fall into the group with no distance, so that one
    # pass also gives the number of sources.
    per_round = (
        reached.join(degrees, reached["node"] == degrees["src"], "full")
        .groupBy("distance")
        .agg(
            F.count("node").alias("frontier_nodes"),
            F.coalesce(F.sum("out_edges"), F.lit(0)).alias("frontier_edges"),
            F.count("src").alias("_sources"),
            F.count_if(F.col("src").isNull()).alias("_new_ids"),
        )
    )
    # One row per round: these windows do not grow with the data.
    all_rounds = Window.orderBy("distance").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    so_far = Window.orderBy("distance").rowsBetween(Window.unboundedPreceding, 0)
    state_rows = F.sum("_sources").over(all_rounds) + F.sum("_new_ids").over(so_far)
    return (
        per_round.select(
            (F.col("distance") + 1).alias("round"),
            "frontier_nodes",
            "frontier_edges",
            (state_rows + F.col("frontier_edges")).alias("processed"),
        )
        .where(F.col("round").isNotNull())
    )
