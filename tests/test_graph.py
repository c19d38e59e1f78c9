import itertools
import random
from collections import Counter, deque

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import edge_tables, graph, naming, skew, two_sided
from millrace.operators.ordering import grouped_totals
from millrace.plans import inputs
from millrace.sources import scratch_path, sinks, text

CHAIN = [(1, 2), (2, 3), (3, 4), (9, 8)]
DIAMOND = [(1, 2), (1, 3), (2, 4), (3, 4)]
CYCLE = [(1, 2), (2, 3), (3, 1)]
LONG = [(i, i + 1) for i in range(1, 23)]
# One source holds most edges, one edge most copies.
HUB = [(0, i) for i in range(1, 60)] + [(5, 70)] * 40 + [(i, i + 1) for i in range(1, 20)]


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def by_hand(pairs, start):
    out = {}
    for a, b in pairs:
        out.setdefault(a, []).append(b)
    seen, queue = {start: 0}, deque([start])
    while queue:
        at = queue.popleft()
        for b in out.get(at, []):
            if b not in seen:
                seen[b] = seen[at] + 1
                queue.append(b)
    return seen


def degree(spark, pairs, start, target, **params):
    row = graph.degree_of_separation(edges(spark, pairs), start, target, **params).first()
    return row.degree, row.directions


@pytest.mark.parametrize(
    "pairs, start, target, want",
    [
        (CHAIN, 1, 4, (3, 1)),
        (CHAIN, 1, 9, (None, 0)),
        (CHAIN, 4, 1, (None, 0)),
        (CHAIN, 77, 1, (None, 0)),
        (CHAIN, 1, 1, (None, 0)),
        (DIAMOND, 1, 4, (2, 2)),
        (DIAMOND + [(2, 4)], 1, 4, (2, 3)),
        (CYCLE, 1, 1, (3, 1)),
        ([(1, 1), (1, 2)], 1, 1, (1, 1)),
        (LONG, 1, 21, (20, 1)),
        (LONG, 1, 22, (21, 1)),
    ],
)
def test_degree(spark, pairs, start, target, want):
    assert degree(spark, pairs, start, target) == want


@pytest.mark.parametrize("block_rows", [1, 7, 100_000])
def test_split_sources_change_nothing(spark, block_rows):
    got = graph.distances_from(edges(spark, HUB), 0, block_rows=block_rows).collect()
    want = by_hand(HUB, 0)
    assert {r.node: r.distance for r in got} == {n: want.get(n) for p in HUB for n in p}
    assert degree(spark, HUB, 0, 70, block_rows=block_rows) == (2, 40)


def test_adjacency_is_one_row_per_node(spark):
    got = graph.adjacency_list(edges(spark, HUB)).collect()
    assert Counter((r.node, n) for r in got for n in r.neighbours) == Counter(HUB)
    assert all(r.neighbours == sorted(r.neighbours) for r in got)
    assert set(Counter(r.node for r in got).values()) == {1}


@pytest.mark.parametrize("part_rows", [1, 7, 100_000])
def test_adjacency_parts_have_one_shape(spark, part_rows):
    """The sorted neighbours in parts of one size, hot nodes and many copies alike."""
    pairs = HUB + [(900, 1)] * 23 + [(900, 2)] * 2
    got = graph.partitioned_adjacency(edges(spark, pairs).repartition(5), part_rows).collect()
    whole = {}
    for src, dst in pairs:
        whole.setdefault(src, []).append(dst)
    want = {
        (src, at // part_rows): sorted(own)[at : at + part_rows]
        for src, own in whole.items()
        for at in range(0, len(own), part_rows)
    }
    assert {(r.node, r.part): r.neighbours for r in got} == want and len(got) == len(want)


def test_grouped_totals_restart_in_every_group(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.randrange(5)) for g in ([None, "a", "b"] + [f"g{i}" for i in range(30)]) for i in range(1 if g and g[0] == "g" else 200)]
    df = spark.createDataFrame(rows, "g string, at int, n bigint").repartition(7)
    got = {(r.g, r.at): (r.position, r.n_upto) for r in grouped_totals(df, ["g"], [F.asc("at")], ["n"]).collect()}
    upto = Counter()
    for g, at, n in rows:
        upto[g] += n
        assert got[g, at] == (at + 1, upto[g])
    assert len(got) == len(rows)


def test_split_only_hot_sources(spark):
    """Few rows per block, and as many hot keys as four per partition at most."""
    profile = skew.profile_key(edges(spark, HUB), "src", 7)
    assert profile.rows == len(HUB)
    assert {k for k, _ in profile.hot} == {0, 5}
    assert len(profile.hot) <= 4 * profile.partitions


def test_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for block_rows in (7, 100_000):
            got = graph.distances_from(edges(spark, HUB), 0, block_rows=block_rows).collect()
            want = by_hand(HUB, 0)
            assert {r.node: r.distance for r in got} == {n: want.get(n) for p in HUB for n in p}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_round_shuffles_frontier_but_not_edges(spark, monkeypatch, block_rows):
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with graph.edge_store(edges(spark, HUB), block_rows) as store:
            plan = store.expand(spark.range(3).select(F.col("id").alias("node")))
            text = plan._jdf.queryExecution().executedPlan().toString()
            live = text[: text.index("InMemoryRelation")]
            assert "SortMergeJoin" in live
            assert live.count("Exchange hash") == 1 and live.count("Sort [") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=20),
    st.integers(0, 7),
)
def test_distances_of_any_graph(spark, pairs, start):
    got = {r.node: r.distance for r in graph.distances_from(edges(spark, pairs), start).collect()}
    want = by_hand(pairs, start)
    assert got == {n: want.get(n) for p in pairs for n in p}


def test_distance_grows_by_one_at_most_along_an_edge(spark, sf_dir):
    graph_edges = inputs.edges(spark, sf_dir)
    got = {r.node: r.distance for r in graph.distances_from(graph_edges, 0).collect()}
    for r in graph_edges.collect():
        if got[r.src] is not None:
            assert got[r.dst] is not None and got[r.dst] <= got[r.src] + 1


def processed_by_hand(pairs, start, rounds):
    seen = by_hand(pairs, start)
    sources = {a for a, _ in pairs}
    out = []
    for i in range(1, rounds + 1):
        frontier = [n for n, d in seen.items() if d == i - 1]
        if not frontier:
            break
        out_edges = sum(a in frontier for a, _ in pairs)
        state = sources | {n for n, d in seen.items() if d <= i - 1}
        out.append((i, len(frontier), out_edges, len(state) + out_edges))
    return out


@pytest.mark.parametrize("pairs, start", [(CHAIN, 1), (DIAMOND, 1), (HUB, 0), (CYCLE, 2), (LONG, 1)])
def test_progress(spark, pairs, start):
    got = sorted(tuple(r) for r in graph.progress(edges(spark, pairs), start).collect())
    assert got == processed_by_hand(pairs, start, 100)


def test_progress_stops_at_the_target(spark):
    got = sorted(tuple(r) for r in graph.progress(edges(spark, LONG), 1, target=4).collect())
    assert got == processed_by_hand(LONG, 1, 3)
    got = sorted(tuple(r) for r in graph.progress(edges(spark, CYCLE), 1, target=1).collect())
    assert got == processed_by_hand(CYCLE, 1, 3)


def test_state_colours(spark):
    got = {r.node: (r.distance, r.colour) for r in graph.state_after(edges(spark, CHAIN), 1, 2).collect()}
    assert got == {
        1: (0, "BLACK"),
        2: (1, "BLACK"),
        3: (2, "GRAY"),
        4: (None, "WHITE"),
        8: (None, "WHITE"),
        9: (None, "WHITE"),
    }
    first = {r.node: r.colour for r in graph.initial_state(edges(spark, CHAIN), 1).collect()}
    assert first[1] == "GRAY" and set(first.values()) == {"GRAY", "WHITE"}


def test_merge_takes_least_distance_and_darkest_colour(spark):
    rows = []
    for node, (a, b) in enumerate(itertools.product(["WHITE", "GRAY", "BLACK"], repeat=2)):
        rows.append((node, [3, 1], None if a == "WHITE" else 2, a))
        rows.append((node, [2], None if b == "WHITE" else 5, b))
    state = spark.createDataFrame(
        rows, "node bigint, neighbours array<bigint>, distance int, colour string"
    )
    dark = ["WHITE", "GRAY", "BLACK"]
    for got in (graph.merge_state(state).collect(), graph.merge_state_parts(state, 2).collect()):
        for node, (a, b) in enumerate(itertools.product(dark, repeat=2)):
            mine = [r for r in got if r.node == node]
            assert sorted(n for r in mine for n in r.neighbours) == [1, 2, 3]
            least = min((d for d, c in ((2, a), (5, b)) if c != "WHITE"), default=None)
            assert {r.distance for r in mine} == {least}
            assert {r.colour for r in mine} == {max(a, b, key=dark.index)}


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("block_rows", [1, 100_000])
def test_nodes_without_neighbours_stay_in_the_graph(spark, block_rows):
    rows = [(1, [2, 2]), (2, []), (5, [])]
    adjacency = spark.createDataFrame(rows, "node bigint, neighbours array<bigint>")
    pairs = graph.edges_of(adjacency)
    got = graph.distances_from(pairs, 1, block_rows=block_rows).collect()
    assert {r.node: r.distance for r in got} == {1: 0, 2: 1, 5: None}
    assert graph.degree_of_separation(pairs, 1, 2, block_rows=block_rows).first().directions == 2
    for back in (graph.adjacency_list(pairs).collect(), graph.partitioned_adjacency(pairs).collect()):
        assert Counter((r.node, n) for r in back for n in r.neighbours) == {(1, 2): 2}
        assert {r.node for r in back} == {1, 2, 5} and len(back) == 3
    # Three rows of state and two out-edges, then the node reached.
    assert sorted(tuple(r) for r in graph.progress(pairs, 1).collect()) == [(1, 1, 2, 5), (2, 1, 0, 3)]


def chain(length):
    return [(i, i + 1) for i in range(length)]


def test_far_targets_are_found_and_short_searches_say_so(spark):
    far = edges(spark, chain(25))
    assert tuple(graph.degree_of_separation(far, 0, 25).first()) == (0, 25, 25, 1, False)
    assert tuple(graph.degree_of_separation(far, 0, 25, max_rounds=5).first()) == (0, 25, None, 0, True)
    assert tuple(graph.degree_of_separation(far, 25, 0, max_rounds=5).first()) == (25, 0, None, 0, False)


def test_progress_without_a_limit(spark):
    rows = sorted(tuple(r) for r in graph.progress(edges(spark, chain(3)), 0).collect())
    assert [(r[0], r[1], r[2]) for r in rows] == [(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 0)]
    assert rows == sorted(tuple(r) for r in graph.progress(edges(spark, chain(3)), 0, max_rounds=20).collect())


def test_unknown_start_reaches_nothing(spark):
    assert graph.reached_from(edges(spark, chain(3)), 77).collect() == []
    assert {r.distance for r in graph.distances_from(edges(spark, chain(3)), 77).collect()} == {None}


def test_expansion_of_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(graph, "profile_key", lambda df, key: skew.profile_key(df, key, 7))
    frontier = spark.createDataFrame([(0, 4), (5, 4), (3, 4)], "node bigint, distance int")
    got = graph.expand_frontier(frontier, edges(spark, HUB)).collect()
    assert Counter((r.src, r.node) for r in got) == Counter(p for p in HUB if p[0] in (0, 3, 5))
    assert {r.distance for r in got} == {5}


@pytest.mark.parametrize("block_rows", [7, 100_000])
def test_two_sided_search_answers_as_the_one_sided(spark, block_rows):
    rng = random.Random(11)
    for pairs in (HUB, chain(9), [(rng.randrange(30), rng.randrange(30)) for _ in range(60)], [(1, 1), (1, 2), (2, 1), (1, 2)]):
        nodes = sorted({n for p in pairs for n in p})
        frame = edges(spark, pairs).cache()
        for start, target in [(nodes[0], nodes[-1]), (nodes[0], nodes[0]), (nodes[1], nodes[0]), (nodes[0], 999)]:
            one = graph.degree_of_separation(frame, start, target, block_rows=block_rows).first()
            assert two_sided.degree_of_separation(frame, start, target, block_rows=block_rows).first() == one


def test_two_sided_search_reads_fewer_edges(spark):
    """Two trees that grow towards each other's roots along one path."""
    pairs = [(i, 3 * i + j) for i in range(400) for j in (1, 2, 3)]
    pairs += [(10_000 + 3 * i + j, 10_000 + i) for i in range(400) for j in (1, 2, 3)]
    pairs += [(40, 10_040)]
    frame = edges(spark, pairs)
    degrees = Counter(src for src, _ in pairs)
    turned = Counter(dst for _, dst in pairs)
    with graph.edge_store(frame) as ahead, graph.edge_store(frame.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) as back:
        walk = graph.traverse(ahead, 0, 10_000)
        found = two_sided.meet(ahead, back, 0, 10_000)
        one_sided = sum(degrees[r.node] for r in walk.reached.where(F.col("distance") < walk.hit_round).collect())
        both = sum(
            counts[r.node]
            for side, counts in ((found.forward, degrees), (found.backward, turned))
            for depth in range(side.depth)
            for r in side.level(depth).collect()
        )
    assert (found.degree, found.directions) == (walk.hit_round, walk.hits) == (9, 1)
    assert both < one_sided / 2


def test_edge_table_is_not_shuffled_again(spark, tmp_path):
    folder = scratch_path(spark, "edge-table")
    edge_tables.save_edge_table(edges(spark, HUB), folder, buckets=4, block_rows=7)
    store = edge_tables.open_edge_table(spark.newSession(), folder)
    assert {k for k, _ in store.profile.hot} == {0}  # 59 edges; the copies of one edge are one row
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for start in (0, 3):
            other = edge_tables.open_edge_table(spark, folder)
            plan = other.expand(spark.range(start, start + 1).select(F.col("id").alias("node")))._jdf.queryExecution().executedPlan().toString()
            shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            scan = plan.index("Scan parquet")
            assert len(shuffled) == 1 and plan.index("Exchange hashpartitioning") < scan and "Bucketed: true" in plan
            want = by_hand(HUB, start)
            assert {r.node: r.distance for r in graph.traverse(other, start).reached.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Counter((r.src, r.dst) for r in edge_tables.reversed_edges(store).collect()) == Counter((b, a) for a, b in HUB)


def test_named_graph(spark):
    rows = [("b", "a"), ("a", "ä b"), ("b", "a"), ("c", None), (None, "a"), ("ä b", "d")]
    frame = spark.createDataFrame(rows, "src string, dst string").repartition(3)
    named = naming.named_graph(frame)
    ids = {r["name"]: r.id for r in named.names.collect()}
    assert ids == {n: i for i, n in enumerate(sorted(["a", "b", "c", "d", "ä b"], key=str.encode))}
    assert {r.node: r.neighbours for r in named.adjacency().collect()} == {"a": ["ä b"], "b": ["a", "a"], "c": [], "ä b": ["d"]}
    assert {r.node: r.distance for r in named.distances_from("b").collect()} == {"b": 0, "a": 1, "ä b": 2, "d": 3, "c": None}
    assert tuple(named.degree_of_separation("b", "a").first()) == ("b", "a", 1, 2, False)
    assert tuple(named.degree_of_separation("b", "nobody").first()) == ("b", "nobody", None, 0, False)
    assert {r.distance for r in named.distances_from("nobody").collect()} == {None}


def test_dictionary_joins_without_broadcast(spark):
    frame = spark.createDataFrame([("b", "a")], "src string, dst string")
    named = naming.named_graph(frame)
    plan = named.named(named.edges, "src")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_graph_of_the_size_of_a_road_map(spark, tmp_path):
    """An edge file to an adjacency file: each edge leads from a larger to a smaller
    id, without copies; some ids have no out-edge."""
    rng = random.Random(1)
    pairs = sorted({(a, rng.randrange(1, a)) for a in range(2, 2643) for _ in range(rng.choice((0, 1, 1, 2)))} | {(2642, 1)})
    path = scratch_path(spark, "roads")
    lines = spark.createDataFrame([(f"{a},{b}",) for a, b in pairs], "value string").repartition(3)
    sinks.write_lines(lines, f"{path}/edges")
    parsed = text.parse_edges(text.read_lines(spark, f"{path}/edges"))
    sinks.write_adjacency(graph.adjacency_list(parsed), f"{path}/adjacency")
    back = text.parse_adjacency(text.read_lines(spark, f"{path}/adjacency"))
    assert back.count() == len({a for a, _ in pairs})
    assert sorted((r.src, r.dst) for r in graph.edges_of(back).collect()) == pairs
