"""Resharding by minimum-cost flow.

Old shards supply their bytes, new shards take as many as their capacity, and a
byte that changes its shard costs one. The flow that costs least says how many
bytes go from which shard to which. They are taken from the smallest documents
of a shard, so block edges miss the flow by less than such a document; a second
and third round settle what the edges left. Which document goes where is an
expression over size and a hash of the row, so no text is shuffled: only
aggregated sizes are. Files of shards that neither give nor take stay.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.components import _stored
from millrace.llm.frames import PREFIX, blocks_for, without

SLOT_ROWS = 50_000
ROUNDS = 3
_TIES = 1 << 20


def min_cost_flow(supplies: list[int], capacities: list[int], costs: list[list[int]] | None = None) -> list[list[int]]:
    """Units from each supply to each capacity at the least total cost, by
    successive shortest paths; by default a unit that changes its place costs one.
    The sums must agree. The graph is one node per shard, whatever the data size."""
    n, m = len(supplies), len(capacities)
    if sum(supplies) != sum(capacities):
        raise ValueError("supplies and capacities must have the same sum")
    if costs is None:
        costs = [[int(i != j) for j in range(m)] for i in range(n)]
    flow = [[0] * m for _ in range(n)]
    left, room = list(supplies), list(capacities)
    while any(left):
        # Cheapest way from any supply that is left: over (0, i) and (1, j).
        cost: dict[tuple[int, int], int] = {(0, i): 0 for i in range(n) if left[i]}
        came: dict[tuple[int, int], tuple[int, int]] = {}
        queue = deque(cost)
        while queue:
            side, at = queue.popleft()
            if side == 0:
                steps = [((1, j), costs[at][j]) for j in range(m)]
            else:
                steps = [((0, i), -costs[i][at]) for i in range(n) if flow[i][at]]
            for to, price in steps:
                if cost[side, at] + price < cost.get(to, 1 << 62):
                    cost[to], came[to] = cost[side, at] + price, (side, at)
                    queue.append(to)
        end = min((j for j in range(m) if room[j]), key=lambda j: cost[1, j])
        path = [(1, end)]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        pairs = list(zip(path, path[1:]))
        units = min([left[path[0][1]], room[end], *[flow[b[1]][a[1]] for a, b in pairs if a[0] == 1]])
        for a, b in pairs:
            if a[0] == 0:
                flow[a[1]][b[1]] += units
            else:
                flow[b[1]][a[1]] -= units
        left[path[0][1]] -= units
        room[end] -= units
    return flow


# Where the rows of each old shard go: ascending keys, and the shard of the rows
# from each key to the next; the last range has no end.
Routes = list[list[tuple[int, int]]]


def row_key(size: Column, tie: Column) -> Column:
    """Orders rows by size and then by a hash; one integer."""
    return size * _TIES + tie


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _sizes(rows: DataFrame, shard: str, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in rows.groupBy(shard).agg(F.sum("size")).collect()}  # one row per shard
    return [int(found.get(i, 0)) for i in range(shards)]


def plan_routes(rows: DataFrame, shard: str, shards: int, capacities: list[int] | None = None) -> Routes:
    """Block transfers for rows (size, tie and an old shard 0 to shards - 1)."""
    sizes = _sizes(rows, shard, shards)
    flow = min_cost_flow(sizes, capacities or equal_capacities(sum(sizes), shards))
    wanted = []
    for i in range(shards):
        upto = 0
        for j in range(shards):
            if i != j and flow[i][j]:
                upto += flow[i][j]
                wanted.append((i, j, upto))
    routes: Routes = [[(0, i)] for i in range(shards)]
    if not wanted:
        return routes
    # Totals per size are small, whatever the number of rows.
    per_size = rows.groupBy(F.col(shard).alias("old"), "size").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("old").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    upto = per_size.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    goals = rows.sparkSession.createDataFrame(wanted, "old int, new int, goal bigint")
    edges = (
        upto.join(F.broadcast(goals), "old")  # at most shards * shards rows
        .where("before < goal and goal <= before + bytes")
        .select("old", "new", "goal", row_key(F.col("size"), F.floor((F.col("goal") - F.col("before")) * _TIES / F.col("bytes"))).alias("key"))
    )
    ends: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for r in sorted(edges.collect(), key=lambda r: (r.old, r.goal)):
        ends[r.old].append((r.key, r.new))
    for i, own in enumerate(ends):
        starts = [0, *[key for key, _ in own]]
        routes[i] = list(zip(starts, [*[new for _, new in own], i]))
    return routes


def then(first: Routes, second: Routes) -> Routes:
    """Both moves as one."""
    out: Routes = []
    for ranges in first:
        joined = []
        for (start, place), end in zip(ranges, [*[s for s, _ in ranges[1:]], None]):
            for key, new in second[place]:
                following = [k for k, _ in second[place] if k > key]
                if (following and following[0] <= start) or (end is not None and key >= end):
                    continue
                joined.append((max(start, key), new))
        out.append(joined)
    return out


def routed(shard: Column, key: Column, routes: Routes) -> Column:
    """The new shard of a row: that of its last range that begins at or before the
    row's key. The ranges are a small constant (about shards * shards)."""
    shape = "array<array<struct<start:bigint,place:int>>>"
    table = F.from_json(F.lit(json.dumps([[{"start": k, "place": p} for k, p in r] for r in routes])), shape)
    own = F.element_at(table, shard + 1)
    return F.element_at(F.filter(own, lambda x: x["start"] <= key), -1)["place"]


@dataclass(frozen=True)
class Shards:
    """Where the files of each shard are: folders with a subfolder per shard."""

    places: dict[int, str]

    def read(self, spark: SparkSession) -> DataFrame:
        folders: dict[str, list[int]] = {}
        for shard, folder in self.places.items():
            folders.setdefault(folder, []).append(shard)
        parts = [spark.read.parquet(f).where(F.col("shard").isin(s)) for f, s in sorted(folders.items())]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def write_shards(docs: DataFrame, shard: Column, shards: int, folder: str) -> Shards:
    """Write `docs` with a subfolder per shard; each task writes its own rows, so
    nothing is shuffled and a hot shard is no single task. Missing shard numbers
    have no files; a column `shard` of `docs` is replaced."""
    own = f"{PREFIX}shard"
    docs = without(docs.withColumn(own, shard.cast("int")), ("shard",)).withColumnRenamed(own, "shard")
    docs.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return Shards(dict.fromkeys(range(shards), folder))


def reshard_bytes(spark: SparkSession, old: Shards, shards: int, folder: str, rounds: int = ROUNDS) -> Shards:
    """Make the byte sizes of `shards` shards near equal, moving the fewest bytes,
    and write the files of the shards that change into `folder`.

    Sizes differ by about the smallest documents; by more only where a single
    document exceeds an equal share. NULL and empty texts count one byte. An empty
    table moves nothing.
    """
    docs = old.read(spark)
    tie = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_TIES))
    thin = _stored(docs.select("shard", text_size().alias("size"), tie.alias("tie")), "sizes")
    key = row_key(F.col("size"), F.col("tie"))
    routes: Routes = [[(0, i)] for i in range(shards)]
    for _ in range(rounds):
        placed = thin.withColumn("place", routed(F.col("shard"), key, routes))
        routes = then(routes, plan_routes(placed, "place", shards))
    moves = {(i, place) for i, ranges in enumerate(routes) for _, place in ranges if place != i}
    touched = {shard for move in moves for shard in move}
    if not touched:
        return old
    rows = docs.where(F.col("shard").isin(sorted(touched)))
    write_shards(rows, routed(F.col("shard"), row_key(text_size(), tie), routes), shards, folder)
    return Shards({s: folder if s in touched else old.places[s] for s in range(shards)})


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Adds `slot`, gapless from 0 within each `shard`, in the order of a hash.
    Rows are numbered in parts of a shard, and parts offset by the counts before.
    `rows` are narrow and kept in the shared folder, so both steps see the same."""
    rows = _stored(rows, "slots")
    total = rows.count()
    part = f"{PREFIX}part"
    rows = rows.withColumn(part, F.pmod(F.xxhash64(*rows.columns), F.lit(blocks_for(total, slot_rows))))
    counts = rows.groupBy("shard", part).count()
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(f"{PREFIX}before"))
    within = Window.partitionBy("shard", part).orderBy(*[c for c in rows.columns if c not in ("shard", part)])
    return (
        rows.withColumn("slot", F.row_number().over(within).cast("bigint"))
        .join(offsets, ["shard", part])
        .withColumn("slot", F.col("slot") - 1 + F.col(f"{PREFIX}before"))
        .drop(part, f"{PREFIX}before")
    )
