"""K-means: Lloyd rounds over DataFrames, and the library estimator."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import euclidean, nearest
from millrace.functions.vectors import nearest_index_of
from millrace.operators.caching import cached, in_few_tasks, placed_by_content

# The parameters of the two library runs and of the Lloyd loop.
MANY_CLUSTERS = 51
FEW_CLUSTERS = 10
FEW_CLUSTERS_MAX_ITER = 30
NO_ITERATION_LIMIT = 2147483647
SEED = 1
STOP_MOVEMENT = 0.1
# Seeds nearer than this, relative to the largest of their coordinate, are the same.
SEED_ROUNDING = 1e-12

Centroids = Sequence[Sequence[float]]


# --- one round, as DataFrames ----------------------------------------------


def seed_rows(
    seeds: DataFrame, coords: Sequence[str], order_by: str | Column
) -> list[list[float]]:
    """The K seed points, in order. K is chosen by the caller, never the data."""
    return [list(r) for r in seeds.orderBy(order_by).select(*coords).collect()]


def _distance_places(coords: Sequence[str], distance_cols: Sequence[str] | None) -> list[int]:
    """Positions in `coords` of the coordinates that count as distance."""
    unknown = set(distance_cols or ()) - set(coords)
    if unknown:
        raise ValueError(f"not among the coordinates: {sorted(unknown)}")
    return [i for i, c in enumerate(coords) if c in (distance_cols or coords)]


def assign(
    points: DataFrame,
    centroids: Centroids,
    coords: Sequence[str],
    distance_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add `cluster`, the index of the nearest centroid. No shuffle."""
    at = _distance_places(coords, distance_cols)
    fixed = [[row[i] for i in at] for row in centroids]
    return points.withColumn("cluster", nearest([F.col(coords[i]) for i in at], fixed))


def cluster_means(assigned: DataFrame, coords: Sequence[str], key: str = "cluster") -> DataFrame:
    """Mean of each coordinate and row count per key (combined map-side)."""
    return assigned.groupBy(key).agg(
        *[F.avg(c).alias(c) for c in coords], F.count(F.lit(1)).alias("n")
    )


def centroid_shift(
    old: DataFrame, new: DataFrame, coords: Sequence[str], key: str = "cluster"
) -> DataFrame:
    """One row: the summed distance between old and new centroids.

    A cluster without new members keeps its place and adds nothing.
    """
    moved = old.alias("o").join(new.alias("n"), key)
    distance = euclidean(
        [F.col(f"o.{c}") for c in coords], [F.col(f"n.{c}") for c in coords]
    )
    return moved.agg(F.coalesce(F.sum(distance), F.lit(0.0)).alias("shift"))


# --- the Lloyd loop --------------------------------------------------------


@dataclass
class LloydResult:
    centroids: list[list[float]]
    coords: list[str]
    sizes: list[int] = field(default_factory=list)
    shifts: list[float] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.shifts)

    def moving(self, stop_movement: float, max_iter: int | None) -> bool:
        """Whether another round is due."""
        settled = bool(self.shifts) and self.shifts[-1] <= stop_movement
        return not settled and (max_iter is None or self.rounds < max_iter)

    def centers(self, spark: SparkSession) -> DataFrame:
        """(cluster, coordinates...), K rows."""
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centroids)]
        columns = ", ".join(f"`{c}` double" for c in self.coords)
        return spark.createDataFrame(rows, f"cluster int, {columns}")


# Key of the rows that count what no cluster takes.
_INVALID = -1


def _round_sums(points: DataFrame, centroids: np.ndarray, use: list[int]) -> DataFrame:
    """Per cluster: member count and coordinate sums, K rows at most, and under
    `_INVALID` the number of points with a coordinate that is no number.

    Each task assigns its Arrow batches and adds them up, so that it hands at
    most K + 1 rows to the shuffle however many points one cluster holds.
    """
    k, d = centroids.shape
    nearest_index = nearest_index_of(centroids[:, use])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, invalid = np.zeros(k, dtype="int64"), np.zeros((k, d)), 0
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            usable = ~np.isnan(rows).any(axis=1)
            invalid += len(rows) - int(usable.sum())
            rows = rows[usable]
            index = nearest_index(rows[:, use])
            counts += np.bincount(index, minlength=k)
            for dim in range(d):
                sums[:, dim] += np.bincount(index, weights=rows[:, dim], minlength=k)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[seen, -1], pa.int32()), pa.array(np.r_[counts[seen], invalid])]
            + [pa.array(np.r_[sums[seen, dim], 0.0]) for dim in range(d)],
            names=["cluster", "n", *[f"s{dim}" for dim in range(d)]],
        )

    schema = "cluster int, n bigint" + "".join(f", s{dim} double" for dim in range(d))
    sums = [f"s{dim}" for dim in range(d)]
    return points.mapInArrow(partial, schema).groupBy("cluster").sum("n", *sums)


def move(result: LloydResult, sums: list[tuple], use: list[int], invalid: str) -> None:
    """Take the means of one round (cluster, n, sums...) as new centroids of `result`.
    An empty cluster keeps its centroid."""
    current = np.asarray(result.centroids)
    fresh, sizes = current.copy(), [0] * len(current)
    for cluster, n, *totals in sums:
        if cluster == _INVALID:
            if n and invalid == "error":
                raise ValueError(f"{n} points have a coordinate that is NULL or not a number")
            continue
        sizes[cluster] = n
        fresh[cluster] = np.array(totals) / n
    result.shifts.append(float(np.sqrt(((fresh - current)[:, use] ** 2).sum(axis=1)).sum()))
    result.centroids, result.sizes = fresh.tolist(), sizes


def lloyd(
    points: DataFrame,
    seeds: Centroids,
    coords: Sequence[str],
    distance_cols: Sequence[str] | None = None,
    max_iter: int | None = None,
    stop_movement: float = STOP_MOVEMENT,
    invalid: str = "error",
    folder: str | None = None,
) -> LloydResult:
    """Assign, average, repeat until the centroids together move at most
    `stop_movement` or `max_iter` rounds are done.

    `distance_cols` limits which coordinates count as distance; all are
    averaged. An empty cluster keeps its centroid. One pass over the cached
    points per round; only K rows per round reach the driver.

    A point with a NULL or NaN coordinate is an error, or left out if `invalid` is
    "drop". With a `folder` every round's centroids are kept there, and a run that
    finds rounds in it goes on after the last; `max_iter` counts them.
    """
    if invalid not in ("error", "drop"):
        raise ValueError(f"unknown treatment of invalid points: {invalid}")
    coords = list(coords)
    use = _distance_places(coords, distance_cols)
    result = LloydResult(np.asarray(seeds, dtype=float).tolist(), coords)
    log = RoundLog(points.sparkSession, folder) if folder else None
    if log:
        log.restore(result)
    with cached(points.select([F.col(c).cast("double") for c in coords])) as held:
        tasks = in_few_tasks(held)
        while result.moving(stop_movement, max_iter):
            move(result, _round_sums(tasks, np.asarray(result.centroids), use).collect(), use, invalid)
            if log:
                log.add(result)
    return result


def _same_up_to_rounding(a: Centroids, b: Centroids) -> bool:
    """Whether two lists of centroids differ by no more than the order of sums can."""
    x, y = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    if x.shape != y.shape:
        return False
    largest = np.abs(x).max(axis=0, initial=0.0)
    return bool(((x == y) | (np.abs(x - y) <= SEED_ROUNDING * largest)).all())


_ROUNDS = "round int, cluster int, center array<double>, size bigint, shift double"


@dataclass
class RoundLog:
    """The centroids of finished rounds in a folder, K rows a round."""

    spark: SparkSession
    folder: str

    def rounds(self) -> DataFrame:
        return self.spark.read.schema(_ROUNDS).parquet(self.folder)

    def add(self, result: LloydResult) -> None:
        sizes = result.sizes or [0] * len(result.centroids)
        shift = result.shifts[-1] if result.shifts else None
        rows = [
            (result.rounds, i, list(map(float, c)), int(n), shift)
            for i, (c, n) in enumerate(zip(result.centroids, sizes))
        ]
        self.spark.createDataFrame(rows, _ROUNDS).coalesce(1).write.mode("append").parquet(self.folder)

    def restore(self, result: LloydResult) -> None:
        """Set `result` to the last round; start the log, if it is empty, with the
        seeds. Seeds other than the log's are an error, but for rounding: a run that
        derives its points anew may add up doubles in another order."""
        try:
            rows = self.rounds().orderBy("round", "cluster").collect()  # K rows a round
        except AnalysisException:  # no such folder yet
            rows = []
        if not rows:
            self.add(result)
            return
        if not _same_up_to_rounding([list(r.center) for r in rows if r.round == 0], result.centroids):
            raise ValueError(f"{self.folder} holds the rounds of other seeds")
        last = rows[-1].round
        result.centroids = [list(r.center) for r in rows if r.round == last]
        result.sizes = [r.size for r in rows if r.round == last]
        result.shifts = [r.shift for r in rows if r.cluster == 0 and r.round > 0]


# --- the library estimator -------------------------------------------------


def fit_kmeans(
    vectors: DataFrame,
    k: int = MANY_CLUSTERS,
    max_iter: int = NO_ITERATION_LIMIT,
    seed: int = SEED,
    init_mode: str = "random",
    features: str = "features",
) -> KMeansModel:
    """Library k-means over a vector column. The start is drawn by partition, so rows
    are placed by their content: the seed alone decides it, on any machine."""
    estimator = KMeans(
        featuresCol=features, k=k, maxIter=max_iter, seed=seed, initMode=init_mode
    )
    rows = vectors.select(features, vector_to_array(features).alias("_values"))
    with cached(placed_by_content(rows, ["_values"]).select(features)) as held:
        return estimator.fit(held)


def kmeans_centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """(cluster, center), K rows."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def kmeans_summary(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """Facts of the fit, one row per cluster with its size."""
    summary = model.summary
    facts = (
        summary.k,
        summary.numIter,
        float(summary.trainingCost),
        len(model.clusterCenters()[0]),
        model.getDistanceMeasure(),
    )
    rows = [(*facts, i, int(n)) for i, n in enumerate(summary.clusterSizes)]
    return spark.createDataFrame(
        rows,
        "k int, iterations int, training_cost double, num_features int, "
        "distance_measure string, cluster int, size bigint",
    )
