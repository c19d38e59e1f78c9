"""K-means rounds that skip distances a point's bounds rule out.

A point keeps its cluster, an upper bound of the distance to that centroid and a lower
bound of the distance to any other. When centroids move, the bounds move with them;
only where they no longer tell the nearest centroid are distances computed, first to
the point's own centroid, then to all. Assignments are those of the plain loop.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.vectors import nearest_index_of
from millrace.operators.clustering import (
    STOP_MOVEMENT,
    Centroids,
    LloydResult,
    RoundLog,
    _distance_places,
    move,
)
from millrace.sources.scratch import scratch_path

# Bounds are sums of rounded numbers: distances this close are compared exactly.
SLACK = 1e-9


@dataclass
class PrunedResult(LloydResult):
    # Distances computed in each round of this run.
    distances: list[int] = field(default_factory=list)


def _advance(old: np.ndarray | None, new: np.ndarray, use: list[int], d: int):
    """Rows (point, cluster, upper, lower, coordinates) to those of the next round, and
    at a task's end its sums per cluster, marked by `point` false."""
    k = len(new)
    here = new[:, use]
    nearest_index = nearest_index_of(here)
    moved = np.zeros(k) if old is None else np.sqrt(((new - old)[:, use] ** 2).sum(axis=1))
    furthest = int(np.argmax(moved))
    second = float(np.max(np.delete(moved, furthest), initial=0.0))
    apart = np.sqrt(((here[:, None] - here[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    half = apart.min(axis=1) / 2  # no other centroid is nearer than this

    def distances(rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), k))
        for at in range(0, len(rows), max(1, 1_000_000 // k)):
            part = rows[at : at + max(1, 1_000_000 // k)]
            squares = np.zeros((len(part), k))
            for dim in range(part.shape[1]):
                squares += (part[:, dim, None] - here[None, :, dim]) ** 2
            out[at : at + len(part)] = np.sqrt(squares)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, invalid, computed = np.zeros(k, dtype="int64"), np.zeros((k, d)), 0, 0
        names = ["point", "cluster", "n", "upper", "lower", *[f"c{i}" for i in range(d)]]

        def batch_of(point, cluster, n, upper, lower, rows):
            columns = [pa.array([point] * len(cluster), pa.bool_()), pa.array(cluster, pa.int32()), pa.array(n, pa.int64())]
            columns += [pa.array(upper, pa.float64()), pa.array(lower, pa.float64())]
            return pa.RecordBatch.from_arrays(columns + [pa.array(rows[:, i]) for i in range(d)], names=names)

        for batch in batches:
            rows = np.column_stack([batch[f"c{i}"].to_numpy(zero_copy_only=False) for i in range(d)])
            usable = ~np.isnan(rows).any(axis=1)
            invalid += len(rows) - int(usable.sum())
            rows = rows[usable]
            place = rows[:, use]
            cluster = batch["cluster"].to_numpy(zero_copy_only=False)[usable].astype("int64")
            upper = batch["upper"].to_numpy(zero_copy_only=False)[usable] + moved[cluster]
            lower = batch["lower"].to_numpy(zero_copy_only=False)[usable] - np.where(cluster == furthest, second, moved[furthest])
            least = np.maximum(half[cluster], lower)
            unsure = np.flatnonzero(upper * (1 + SLACK) >= least)
            if old is not None and len(unsure):
                own = np.sqrt(((place[unsure] - here[cluster[unsure]]) ** 2).sum(axis=1))
                computed += len(unsure)
                upper[unsure] = own
                unsure = unsure[own * (1 + SLACK) >= least[unsure]]
            if len(unsure):
                found = distances(place[unsure])
                computed += found.size
                cluster[unsure] = nearest_index(place[unsure])
                own = found[np.arange(len(unsure)), cluster[unsure]]
                found[np.arange(len(unsure)), cluster[unsure]] = np.inf
                upper[unsure], lower[unsure] = own, found.min(axis=1)
            counts += np.bincount(cluster, minlength=k)
            for dim in range(d):
                sums[:, dim] += np.bincount(cluster, weights=rows[:, dim], minlength=k)
            yield batch_of(True, cluster, np.ones(len(cluster)), upper, lower, rows)
        seen = np.flatnonzero(counts)
        yield batch_of(
            False,
            np.r_[seen, -1, -2],  # -1 counts invalid points, -2 distances
            np.r_[counts[seen], invalid, computed],
            np.zeros(len(seen) + 2),
            np.zeros(len(seen) + 2),
            np.vstack([sums[seen], np.zeros((2, d))]),
        )

    return run


def lloyd_pruned(
    points: DataFrame,
    seeds: Centroids,
    coords: Sequence[str],
    distance_cols: Sequence[str] | None = None,
    max_iter: int | None = None,
    stop_movement: float = STOP_MOVEMENT,
    invalid: str = "error",
    folder: str | None = None,
) -> PrunedResult:
    """The centroids of `clustering.lloyd`, from fewer distances.

    Each round writes the points with their bounds to the shared folder, which
    cuts the lineage: a lost executor costs a part of a round. With a `folder` a run
    goes on after the last round that is complete there.
    """
    spark = points.sparkSession
    coords = list(coords)
    use = _distance_places(coords, distance_cols)
    d = len(coords)
    base = folder or scratch_path(spark, "pruned")
    result = PrunedResult(np.asarray(seeds, dtype=float).tolist(), coords)
    log = RoundLog(spark, f"{base}/log") if folder else None
    before = None
    if log:
        log.restore(result)
        if result.rounds:
            previous = log.rounds().where(F.col("round") == result.rounds - 1).orderBy("cluster")
            before = np.array([r.center for r in previous.collect()])  # K rows
    schema = "point boolean, cluster int, n bigint, upper double, lower double" + "".join(f", c{i} double" for i in range(d))

    def table(number: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{base}/round={number:06d}")

    while result.moving(stop_movement, max_iter):
        number = result.rounds
        if number == 0:
            start = [F.lit(True).alias("point"), F.lit(0).alias("cluster"), F.lit(1).cast("bigint").alias("n")]
            start += [F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower")]
            rows = points.select(*start, *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(coords)])
        else:
            rows = table(number).where("point")
        now = np.asarray(result.centroids)
        rows.mapInArrow(_advance(before, now, use, d), schema).write.mode("overwrite").parquet(f"{base}/round={number + 1:06d}")
        sums = (
            table(number + 1).where("not point").groupBy("cluster")
            .agg(F.sum("n").alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(d)])
            .collect()  # K rows and two counts
        )
        result.distances.append(sum(r.n for r in sums if r.cluster == -2))
        move(result, [tuple(r) for r in sums if r.cluster != -2], use, invalid)
        before = now
        if log:
            log.add(result)
    return result
