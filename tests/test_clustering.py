import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import nearest
from millrace.functions.vectors import nearest_index_of
from millrace.operators import clustering, evaluation, features, pruned_kmeans, relational
from millrace.sources import scratch_path

COORDS = ["x", "y", "z", "w"]


def points(spark, rows):
    return spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(rows)], "id int, x double, y double, z double, w double"
    )


def blobs(n=200, seed=3):
    rng = random.Random(seed)
    centers = [[rng.uniform(-50, 50) for _ in COORDS] for _ in range(5)]
    return [[c + rng.gauss(0, 2) for c in rng.choice(centers)] for _ in range(n)]


def lloyd_by_hand(rows, seeds, use, max_iter):
    seeds = [list(s) for s in seeds]
    costs = []
    for _ in range(max_iter):
        members = [[] for _ in seeds]
        cost = 0.0
        for p in rows:
            d = [math.sqrt(sum((p[i] - s[i]) ** 2 for i in use)) for s in seeds]
            members[d.index(min(d))].append(p)
            cost += min(d) ** 2
        costs.append(cost)
        fresh = [
            [sum(p[i] for p in m) / len(m) for i in range(4)] if m else s
            for m, s in zip(members, seeds)
        ]
        moved = sum(math.sqrt(sum((a[i] - b[i]) ** 2 for i in use)) for a, b in zip(fresh, seeds))
        seeds = fresh
        if moved <= 0.1:
            break
    return seeds, costs


@pytest.mark.parametrize("use", [[0, 1, 2, 3], [0, 1]])
def test_lloyd_equals_a_plain_loop(spark, use):
    rows = blobs()
    result = clustering.lloyd(
        points(spark, rows), rows[:7], COORDS, [COORDS[i] for i in use], max_iter=50
    )
    want, costs = lloyd_by_hand(rows, rows[:7], use, 50)
    assert np.allclose(result.centroids, want)
    assert result.rounds == len(costs) and result.shifts[-1] <= 0.1
    assert sum(result.sizes) == len(rows)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_depth_separates_only_with_all_dimensions(spark):
    rows = [[0, 0, 0, 0], [0.1, 0, 1, 0], [0, 0, 100, 0], [0.1, 0, 101, 0]]
    seeds = [rows[0], rows[2]]
    frame = points(spark, rows)
    whole = clustering.lloyd(frame, seeds, COORDS, max_iter=5)
    assert [c[2] for c in whole.centroids] == [0.5, 100.5]
    planar = clustering.lloyd(frame, seeds, COORDS, ["x", "y"], max_iter=5)
    assert planar.sizes == [4, 0] and planar.centroids[0][2] == 50.5


def test_empty_cluster_keeps_its_place(spark):
    rows = [[1, 1, 1, 1], [2, 2, 2, 2], [1, 1, 1, 1]]
    result = clustering.lloyd(points(spark, rows), [[1, 1, 1, 1]] * 2, COORDS, max_iter=1)
    assert result.centroids[1] == [1, 1, 1, 1] and result.sizes == [3, 0]


def test_stops_at_the_round_limit(spark):
    rows = blobs()
    result = clustering.lloyd(points(spark, rows), rows[:7], COORDS, max_iter=1, stop_movement=0.0)
    assert result.rounds == 1


def test_nearest_ties_and_nan(spark):
    frame = points(spark, [[0, 0, 0, 0], [math.nan, 0, 0, 0], [5, 0, 0, 0]])
    fixed = [[1.0, 0, 0, 0], [-1.0, 0, 0, 0], [5.0, 0, 0, 0]]
    got = frame.select("id", nearest([F.col(c) for c in COORDS], fixed).alias("k")).collect()
    assert {r.id: r.k for r in got} == {0: 0, 1: 0, 2: 2}
    assert nearest_index_of(np.array([[np.nan], [3.0]]))(np.array([[0.0]])).tolist() == [1]


def test_assign_uses_the_named_dimensions(spark):
    frame = points(spark, [[0, 0, 9, 9]])
    fixed = [[1, 1, 9, 9], [0, 0, 0, 0]]
    assert clustering.assign(frame, fixed, COORDS).first().cluster == 0
    assert clustering.assign(frame, fixed, COORDS, ["x", "y"]).first().cluster == 1


def test_shift_and_means(spark):
    frame = points(spark, [[0, 0, 0, 0], [2, 0, 0, 0], [9, 9, 9, 9]])
    old = clustering.LloydResult([[0, 0, 0, 0], [9, 9, 9, 9], [50, 50, 50, 50]], COORDS).centers(spark)
    assigned = clustering.assign(frame, [list(r[1:]) for r in old.collect()], COORDS)
    new = clustering.cluster_means(assigned, COORDS)
    assert {r.cluster: r.n for r in new.collect()} == {0: 2, 1: 1}
    assert clustering.centroid_shift(old, new, COORDS).first().shift == 1.0


def test_zero_points_are_dropped(spark):
    frame = points(spark, [[0, 0, 0, 0], [0, 0, 0, 1]])
    assert [r.id for r in relational.drop_all_zero(frame, COORDS).collect()] == [1]


def test_null_points_are_no_zero_points(spark):
    frame = spark.createDataFrame([(0, None, 0.0), (1, 0.0, 0.0), (2, None, None)], "id int, x double, y double")
    assert sorted(r.id for r in relational.drop_all_zero(frame, ["x", "y"]).collect()) == [0, 2]


def test_unknown_distance_columns_are_errors(spark):
    frame = points(spark, [[0, 0, 0, 0], [1, 9, 0, 0]])
    for call in (clustering.assign, clustering.lloyd):
        with pytest.raises(ValueError):
            call(frame, [[0, 0, 0, 0]], COORDS, distance_cols=["no such"])


def test_library_and_loop_agree_on_separated_groups(spark):
    rows = blobs(400)
    frame = points(spark, rows)
    vectors = features.assemble(frame, COORDS)
    model = clustering.fit_kmeans(vectors, k=5)
    loop = clustering.lloyd(frame, [list(c) for c in model.clusterCenters()], COORDS)
    # The loop finds nothing to move in the library's own solution.
    assert loop.rounds <= 2
    summary = clustering.kmeans_summary(spark, model).collect()
    assert [r.size for r in summary] == loop.sizes
    scored = evaluation.silhouette(model.transform(vectors), prediction="prediction").first()
    assert 0.2 < scored.silhouette <= 1
    assert clustering.kmeans_centers(spark, model).count() == 5


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run from elsewhere, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from tests.session import session
from millrace.plans.queries import QUERIES
spark = session("2")
for name in ("nearest_centroid", "lloyd_kmeans"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").collect()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, check=True, timeout=300)


@pytest.mark.parametrize("use", [None, ["x", "y"]])
def test_pruned_rounds_equal_the_plain_loop(spark, use):
    rng = random.Random(8)
    centres = [[rng.uniform(-50, 50) for _ in range(4)] for _ in range(12)]
    rows = [[c + rng.gauss(0, 2) for c in rng.choice(centres)] for _ in range(2000)] + [[1.0] * 4] * 5
    frame, seeds = points(spark, rows).repartition(3), rows[:12]
    plain = clustering.lloyd(frame, seeds, COORDS, use)
    pruned = pruned_kmeans.lloyd_pruned(frame, seeds, COORDS, use)
    assert pruned.rounds == plain.rounds > 2
    assert np.array(pruned.centroids) == pytest.approx(np.array(plain.centroids))
    assert pruned.sizes == plain.sizes and pruned.shifts == pytest.approx(plain.shifts)
    assert pruned.distances[0] == len(rows) * 12
    assert sum(pruned.distances) < 0.6 * len(rows) * 12 * pruned.rounds


@pytest.mark.parametrize("loop", [clustering.lloyd, pruned_kmeans.lloyd_pruned])
def test_a_stopped_run_goes_on(spark, loop):
    rng = random.Random(9)
    rows = [[rng.random() * 9 for _ in range(4)] for _ in range(300)]
    frame, folder = points(spark, rows), scratch_path(spark, "rounds")
    whole = loop(frame, rows[:7], COORDS, stop_movement=1e-9)
    for rounds in (1, 2, 4, None, None):
        result = loop(frame, rows[:7], COORDS, stop_movement=1e-9, max_iter=rounds, folder=folder)
        assert result.rounds == (rounds or whole.rounds)
    assert np.array(result.centroids) == pytest.approx(np.array(whole.centroids))
    assert result.shifts == pytest.approx(whole.shifts) and result.sizes == whole.sizes
    with pytest.raises(ValueError, match="other seeds"):
        loop(frame, rows[1:8], COORDS, folder=folder)


@pytest.mark.parametrize("loop", [clustering.lloyd, pruned_kmeans.lloyd_pruned])
def test_a_run_goes_on_with_seeds_added_up_in_another_order(spark, loop):
    rng = random.Random(11)
    rows = [[rng.random() * 9 for _ in range(4)] for _ in range(100)]
    frame, folder = points(spark, rows), scratch_path(spark, "rounds")
    loop(frame, rows[:5], COORDS, max_iter=1, folder=folder)
    rounded = [[math.nextafter(x, 10.0) for x in row] for row in rows[:5]]
    result = loop(frame, rounded, COORDS, max_iter=2, folder=folder)
    assert result.centroids == loop(frame, rows[:5], COORDS, max_iter=2).centroids
    for others in ([[x + 1e-9 for x in row] for row in rows[:5]], rows[:4]):
        with pytest.raises(ValueError, match="other seeds"):
            loop(frame, others, COORDS, folder=folder)


@pytest.mark.parametrize("loop", [clustering.lloyd, pruned_kmeans.lloyd_pruned])
def test_points_without_a_number(spark, loop):
    rows = [[0.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0], [9.0, 9.0, 9.0, 9.0], [math.nan, 0.0, 0.0, 0.0], [None, 1.0, 1.0, 1.0]]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, x double, y double, z double, w double")
    with pytest.raises(ValueError, match="2 points"):
        loop(frame, rows[:3], COORDS)
    dropped = loop(frame, rows[:3], COORDS, invalid="drop")
    assert dropped.centroids == loop(frame.where("id < 3"), rows[:3], COORDS).centroids
    assert sum(dropped.sizes) == 3


def test_library_fit_does_not_depend_on_the_layout(spark):
    rng = random.Random(10)
    rows = [[rng.random() for _ in range(4)] for _ in range(200)]
    frame = features.assemble(points(spark, rows), COORDS)
    fits = [clustering.fit_kmeans(f, k=5, max_iter=5).clusterCenters() for f in (frame.coalesce(1), frame.repartition(6))]
    assert np.array(fits[0]) == pytest.approx(np.array(fits[1]))
