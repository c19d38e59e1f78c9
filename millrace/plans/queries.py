"""One query per operator over the star-schema tables.

Arrays leave a query as text or as one row per element, and sums of doubles
are rounded, so that results compare by value across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import colour_of, euclidean, split_fields, to_number, vector_add
from millrace.operators import (
    classification,
    clustering,
    edge_tables,
    evaluation,
    features,
    graph,
    naming,
    pruned_kmeans,
    regression,
    relational,
    two_sided,
)
from millrace.operators.caching import cached
from millrace.plans import inputs
from millrace.plans.inputs import COORDS, table
from millrace.sources import quarantine, sinks, text
from millrace.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

START, TARGET = 0, 14
CLUSTERS = clustering.MANY_CLUSTERS
ORIGIN = [1.0, 10.0, 15.0, 0.5]
PLANAR = COORDS[:2]

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__.removesuffix("_query")] = f
    return f


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


# A mean of values with few decimals can lie exactly between two rounded values,
# where the last bit of a sum decides. Shifting by a thirtieth of the last place
# moves such values off the boundary in both engines.
TIE_SHIFT = 0.033
# The logistic solver stops at a relative change of 1e-6.
SOLVER_PLACES = 4


def _rounded(*columns: str, places: int = 6) -> list[Column]:
    shift = TIE_SHIFT * 10**-places
    return [F.round(F.col(c) + shift, places).alias(c) for c in columns]


# --- sources and sinks -----------------------------------------------------


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders")
    sinks.write_csv(orders, path)
    return text.read_csv(spark, path, orders.schema).withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )


@query
def csv_inferred(spark, sf):
    """Types from the file itself."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "orders"), path)
    return text.read_csv(spark, path).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query
def inferred_schema(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "lineitem").select("l_orderkey", "l_tax", "l_returnflag"), path)
    return sinks.schema_report(text.read_csv(spark, path))


def _checked(spark, sf):
    """Order lines of which some lack a field, some hold text for a number."""
    path = scratch_path(spark, "lines")
    price = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey"), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 11 != 0, price))
    sinks.write_lines(table(spark, sf, "orders").select(line.alias("value")), path)
    fields = [quarantine.Field("id", 0, "bigint"), quarantine.Field("status", 1), quarantine.Field("price", 2, "double")]
    return quarantine.check_fields(quarantine.read_located_lines(spark, path), fields)


@query
def checked_lines(spark, sf):
    return _checked(spark, sf).good


@query
def quarantined_lines(spark, sf):
    return _checked(spark, sf).bad.select("reason", "value")


@query
def text_scan(spark, sf):
    path = scratch_path(spark, "text")
    lines = inputs.text_of(
        table(spark, sf, "orders"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    sinks.write_lines(lines, path)
    return text.read_lines(spark, path)


@query
def header_skip(spark, sf):
    path = scratch_path(spark, "headers")
    customer = table(spark, sf, "customer")
    # Several files, so several headers.
    sinks.write_csv(customer.repartition(4, "c_custkey"), path)
    return text.read_csv(spark, path, customer.schema)


@query
def edge_list_parse(spark, sf):
    lines = inputs.text_of(
        table(spark, sf, "orders"), "o_custkey", "o_orderkey", "o_orderpriority"
    )
    return text.parse_edges(lines)


def _adjacency(spark, sf):
    return graph.adjacency_list(inputs.edges(spark, sf))


@query
def adjacency_parse(spark, sf):
    lines = sinks.adjacency_lines(_adjacency(spark, sf))
    return text.parse_adjacency(lines).select("node", _joined("neighbours"))


@query
def adjacency_parse_drop_last(spark, sf):
    lines = sinks.adjacency_lines(_adjacency(spark, sf))
    return text.parse_adjacency(lines, drop_last=True).select("node", _joined("neighbours"))


@query
def point_parse(spark, sf):
    lines = inputs.text_of(
        table(spark, sf, "lineitem"),
        "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )
    return text.parse_points(lines)


@query
def adjacency_text(spark, sf):
    path = scratch_path(spark, "adjacency")
    sinks.write_adjacency(_adjacency(spark, sf), path)
    return text.read_lines(spark, path)


@query
def schema_report(spark, sf):
    return sinks.schema_report(table(spark, sf, "orders"))


# --- projections, filters, samples, splits ---------------------------------


@query
def project_columns(spark, sf):
    return relational.project(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"]
    )


@query
def label_projection(spark, sf):
    return relational.with_label(
        table(spark, sf, "lineitem"), "l_extendedprice", inputs.REGRESSION_FEATURES
    )


@query
def typed_pair(spark, sf):
    flags = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > 150000).alias("prediction"),
        (F.col("o_orderstatus") == "F").alias("label"),
    )
    return relational.typed_pair(flags)


@query
def nonzero_points(spark, sf):
    columns = ["l_discount", "l_tax"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    return relational.drop_all_zero(rows, columns)


@query
def row_count(spark, sf):
    return relational.row_count(table(spark, sf, "lineitem"))


@query
def head_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relational.head_rows(orders, 50, ["o_orderkey"])


@query
def sample_exact(spark, sf):
    return relational.sample_by_hash(
        table(spark, sf, "customer").select("c_custkey", "c_name"), CLUSTERS, "c_custkey"
    )


@query
def sample_random(spark, sf):
    return relational.sample_exact(
        table(spark, sf, "customer").select("c_custkey", "c_name"), CLUSTERS, clustering.SEED, "c_custkey"
    )


@query
def sample_half(spark, sf):
    """A sample too large for one task."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key")
    )
    return relational.sample_by_hash(rows, rows.count() // 2, "key").drop("key")


def _parts(parts: list[DataFrame]) -> DataFrame:
    train, test = parts
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def random_split(spark, sf):
    return _parts(relational.random_split(table(spark, sf, "orders").select("o_orderkey"), key="o_orderkey"))


@query
def hash_split(spark, sf):
    return _parts(relational.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey"))


# --- scalar functions ------------------------------------------------------


@query
def split_fields_query(spark, sf):
    orders = table(spark, sf, "orders")
    line = F.concat(
        F.concat_ws(",", "o_orderkey", "o_orderstatus", F.lit(""), "o_orderpriority"),
        F.repeat(F.lit(","), (F.col("o_orderkey") % 4).cast("int")),
    )
    fields = split_fields(line)
    return orders.select(
        "o_orderkey",
        F.size(fields).alias("n_fields"),
        F.array_join(fields, "|").alias("fields"),
    )


@query
def parse_numbers(spark, sf):
    orders = table(spark, sf, "orders")
    rank = F.substring("o_orderpriority", 1, 1)
    return orders.select(
        "o_orderkey",
        to_number(rank, "int", lenient=True).alias("rank"),
        to_number(F.col("o_orderpriority"), "int", lenient=True).alias("bad"),
        to_number(F.col("o_totalprice").cast("string"), "double", lenient=True).alias("price"),
    )


def _origin_distance(spark, sf, dims):
    fixed = [F.lit(v) for v in ORIGIN[: len(dims)]]
    distance = euclidean([F.col(c) for c in dims], fixed)
    points = inputs.points(spark, sf).select("c_custkey", distance.alias("distance"))
    return points.select("c_custkey", *_rounded("distance"))


@query
def euclidean_distance(spark, sf):
    return _origin_distance(spark, sf, COORDS)


@query
def planar_distance(spark, sf):
    return _origin_distance(spark, sf, PLANAR)


@query
def vector_add_query(spark, sf):
    rows = inputs.points(spark, sf).withColumn("p", F.array(*COORDS))
    total = vector_add(F.col("p"), F.array(*map(F.lit, ORIGIN)))
    return rows.select("c_custkey", F.posexplode(total).alias("dim", "value")).select(
        "c_custkey", "dim", *_rounded("value")
    )


@query
def array_ops(spark, sf):
    neighbours = F.col("neighbours")
    return _adjacency(spark, sf).select(
        "node",
        F.size(neighbours).alias("n"),
        F.array_append(neighbours, F.col("node")).alias("appended"),
        F.concat(neighbours, F.reverse(neighbours)).alias("doubled"),
    ).select("node", "n", _joined("appended"), _joined("doubled"))


# --- graph -----------------------------------------------------------------


@query
def adjacency_list(spark, sf):
    return _adjacency(spark, sf).select("node", _joined("neighbours"))


@query
def bfs_init(spark, sf):
    return graph.initial_state(inputs.edges(spark, sf), START)


def _frontier(reached, distance):
    return reached.where(F.col("distance") == distance)


@query
def frontier_expand(spark, sf):
    edges = inputs.edges(spark, sf)
    reached = graph.reached_from(edges, START, max_rounds=2)
    return graph.expand_frontier(_frontier(reached, 2), edges)


@query
def frontier_anti(spark, sf):
    edges = inputs.edges(spark, sf)
    reached = graph.reached_from(edges, START, max_rounds=2)
    candidates = graph.expand_frontier(_frontier(reached, 2), edges)
    return graph.unvisited(candidates, reached)


@query
def bfs_union(spark, sf):
    edges = inputs.edges(spark, sf)
    state = graph.distances_from(edges, START, max_rounds=2)
    candidates = graph.expand_frontier(_frontier(state, 2), edges).select("node", "distance")
    return graph.union_state(state, candidates)


@query
def bfs_state_merge(spark, sf):
    edges = inputs.edges(spark, sf)
    reached = graph.reached_from(edges, START, max_rounds=2)
    # Own rows carry the neighbours and turn done; emitted rows are new frontier.
    own = (
        graph.adjacency_list(edges)
        .join(reached, "node", "left")
        .select("node", "neighbours", "distance", colour_of(F.col("distance"), 3).alias("colour"))
    )
    emitted = graph.expand_frontier(_frontier(reached, 2), edges).select(
        "node",
        F.array().cast("array<bigint>").alias("neighbours"),
        "distance",
        F.lit("GRAY").alias("colour"),
    )
    return graph.merge_state(graph.union_state(own, emitted)).select(
        "node", _joined("neighbours"), "distance", "colour"
    )


@query
def bfs_step(spark, sf):
    return graph.state_after(inputs.edges(spark, sf), START, 2)


@query
def target_hits(spark, sf):
    edges = inputs.edges(spark, sf)
    return graph.target_hits(graph.reached_from(edges, START), edges, TARGET)


# The answer without the mark of a search that was cut short.
_ANSWER = ["start", "target", "degree", "directions"]


@query
def degree_of_separation(spark, sf):
    return graph.degree_of_separation(inputs.edges(spark, sf), START, TARGET).select(*_ANSWER)


@query
def degree_within_rounds(spark, sf):
    """Too few rounds to meet the target."""
    return graph.degree_of_separation(inputs.edges(spark, sf), START, TARGET, max_rounds=3)


@query
def two_sided_separation(spark, sf):
    """Searches from both ends: the pair, and from a node back to itself."""
    edges = inputs.edges(spark, sf)
    pair = two_sided.degree_of_separation(edges, START, TARGET)
    return pair.unionByName(two_sided.degree_of_separation(edges, START, START))


@query
def partitioned_adjacency(spark, sf):
    rows = graph.partitioned_adjacency(inputs.edges(spark, sf), part_rows=3)
    return rows.select("node", "part", _joined("neighbours"))


def _named(spark, sf):
    """The graph as an edge file of names."""
    path = scratch_path(spark, "names")
    edges = inputs.edges(spark, sf).select(
        *[F.concat(F.lit("customer "), F.col(c).cast("string")).alias(c) for c in ("src", "dst")]
    )
    sinks.write_lines(inputs.text_of(edges, "src", "dst"), path)
    return naming.named_graph(text.parse_edges(text.read_lines(spark, path), names=True))


@query
def id_dictionary(spark, sf):
    return _named(spark, sf).names


@query
def named_adjacency(spark, sf):
    return _named(spark, sf).adjacency().select("node", _joined("neighbours"))


@query
def named_distances(spark, sf):
    return _named(spark, sf).distances_from(f"customer {START}")


@query
def named_separation(spark, sf):
    return _named(spark, sf).degree_of_separation(f"customer {START}", f"customer {TARGET}")


@query
def edge_table_distances(spark, sf):
    """Two traversals from edges that were bucketed once."""
    folder = scratch_path(spark, "edge-table")
    edge_tables.save_edge_table(inputs.edges(spark, sf), folder)
    store = edge_tables.open_edge_table(spark, folder)
    first, second = (graph.traverse(store, start).reached for start in (START, TARGET))
    rows = first.withColumn("start", F.lit(START)).unionByName(second.withColumn("start", F.lit(TARGET)))
    return rows.select("start", "node", "distance")


@query
def state_parts(spark, sf):
    """The state after two rounds with the neighbours in parts."""
    edges = inputs.edges(spark, sf)
    state = graph.state_after(edges, START, 2)
    none = F.array().cast("array<bigint>")
    rows = state.join(graph.adjacency_list(edges), "node", "left").withColumn("neighbours", F.coalesce("neighbours", none))
    merged = graph.merge_state_parts(rows.select("node", "neighbours", "distance", "colour"), part_rows=3)
    return merged.select("node", "part", _joined("neighbours"), "distance", "colour")


@query
def separation_from_file(spark, sf):
    """Both graph jobs in a row: adjacency file out, degree of separation in."""
    path = scratch_path(spark, "adjacency")
    sinks.write_adjacency(_adjacency(spark, sf), path)
    edges = graph.edges_of(text.parse_adjacency(text.read_lines(spark, path)))
    return graph.degree_of_separation(edges, START, TARGET).select(*_ANSWER)


@query
def cycle_length(spark, sf):
    """Start and target the same: the shortest way back."""
    return graph.degree_of_separation(inputs.edges(spark, sf), START, START).select(*_ANSWER)


@query
def distances_from(spark, sf):
    return graph.distances_from(inputs.edges(spark, sf), START)


@query
def bfs_progress(spark, sf):
    return graph.progress(inputs.edges(spark, sf), START)


# --- clustering ------------------------------------------------------------


def _seeds(points: DataFrame) -> list[list[float]]:
    sample = relational.sample_by_hash(points, CLUSTERS, "c_custkey")
    return clustering.seed_rows(sample, COORDS, F.md5(F.col("c_custkey").cast("string")))


def _assigned(spark, sf):
    points = inputs.points(spark, sf)
    seeds = _seeds(points)
    return seeds, clustering.assign(points, seeds, COORDS)


@query
def nearest_centroid(spark, sf):
    return _assigned(spark, sf)[1].select("c_custkey", "cluster")


@query
def cluster_means(spark, sf):
    _, assigned = _assigned(spark, sf)
    return clustering.cluster_means(assigned, COORDS).select("cluster", *_rounded(*COORDS), "n")


@query
def centroid_shift(spark, sf):
    seeds, assigned = _assigned(spark, sf)
    old = clustering.LloydResult(seeds, COORDS).centers(spark)
    new = clustering.cluster_means(assigned, COORDS)
    return clustering.centroid_shift(old, new, COORDS).select(*_rounded("shift"))


def _lloyd(spark, sf, **params):
    with cached(inputs.points(spark, sf)) as points:
        return clustering.lloyd(points, _seeds(points), COORDS, **params)


@query
def lloyd_kmeans(spark, sf):
    result = _lloyd(spark, sf, max_iter=3)
    return result.centers(spark).select("cluster", *_rounded(*COORDS))


@query
def lloyd_kmeans_planar(spark, sf):
    result = _lloyd(spark, sf, max_iter=3, distance_cols=PLANAR)
    return result.centers(spark).select("cluster", *_rounded(*COORDS))


@query
def lloyd_kmeans_converged(spark, sf):
    """The loop with its own stopping rule."""
    result = _lloyd(spark, sf)
    return result.centers(spark).select(
        "cluster", *_rounded(*COORDS), F.lit(result.rounds).alias("rounds")
    )


@query
def lloyd_planar_converged(spark, sf):
    """Two of the four coordinates as distance, until the centroids settle."""
    result = _lloyd(spark, sf, distance_cols=PLANAR)
    return result.centers(spark).select("cluster", *_rounded(*COORDS), F.lit(result.rounds).alias("rounds"))


@query
def lloyd_pruned(spark, sf):
    """The loop that skips distances, with its own stopping rule."""
    with cached(inputs.points(spark, sf)) as points:
        result = pruned_kmeans.lloyd_pruned(points, _seeds(points), COORDS)
    return result.centers(spark).select("cluster", *_rounded(*COORDS), F.lit(result.rounds).alias("rounds"))


@query
def lloyd_resumed(spark, sf):
    """Two rounds, then a run that goes on from them up to five."""
    folder = scratch_path(spark, "rounds")
    _lloyd(spark, sf, max_iter=2, folder=folder)
    result = _lloyd(spark, sf, max_iter=5, folder=folder)
    return result.centers(spark).select("cluster", *_rounded(*COORDS))


@query
def zones_from_file(spark, sf):
    """From a file of points to the zone of sampled labels: parse, drop empty points,
    find zones, assign."""
    path = scratch_path(spark, "points")
    lines = inputs.points(spark, sf).select(F.concat_ws(",", F.concat(F.lit("c"), "c_custkey"), *COORDS).alias("value"))
    sinks.write_lines(lines, path)
    with cached(relational.drop_all_zero(text.parse_points(text.read_lines(spark, path)), COORDS)) as points:
        by_mark = F.md5(F.substring("label", 2, 20))
        seeds = clustering.seed_rows(relational.least_by_mark(points, CLUSTERS, by_mark, ["label"]), COORDS, by_mark)
        centroids = clustering.lloyd(points, seeds, COORDS).centroids
        sample = relational.least_by_mark(points, 10, by_mark, ["label"])
        return clustering.assign(sample, centroids, COORDS).select("label", "cluster")


@query
def assign_sample(spark, sf):
    centroids = _lloyd(spark, sf, max_iter=3).centroids
    sample = relational.sample_by_hash(inputs.points(spark, sf), 10, "c_custkey")
    return clustering.assign(sample, centroids, COORDS).select("c_custkey", "cluster")


def _kmeans(spark, sf):
    rows = features.array_features(inputs.vectors(spark, sf), "embedding")
    model = clustering.fit_kmeans(
        rows, k=clustering.FEW_CLUSTERS, max_iter=clustering.FEW_CLUSTERS_MAX_ITER
    )
    return rows, model


def _points_kmeans(spark, sf):
    rows = features.assemble(inputs.points(spark, sf), COORDS)
    return rows, clustering.fit_kmeans(rows)


@query
def kmeans_fit(spark, sf):
    return clustering.kmeans_summary(spark, _points_kmeans(spark, sf)[1])


@query
def kmeans_predict(spark, sf):
    rows, model = _kmeans(spark, sf)
    return model.transform(rows).select("vec_id", F.col("prediction").alias("cluster"))


@query
def kmeans_centers(spark, sf):
    centers = clustering.kmeans_centers(spark, _kmeans(spark, sf)[1])
    return centers.select("cluster", F.posexplode("center").alias("dim", "value"))


@query
def kmeans_summary(spark, sf):
    return clustering.kmeans_summary(spark, _kmeans(spark, sf)[1])


@query
def kmeans_silhouette(spark, sf):
    rows, model = _kmeans(spark, sf)
    return evaluation.silhouette(model.transform(rows), prediction="prediction")


@query
def silhouette(spark, sf):
    rows = features.array_features(inputs.vectors(spark, sf), "embedding")
    return evaluation.silhouette(rows, prediction="label").select(*_rounded("silhouette"))


# --- features --------------------------------------------------------------


@query
def assemble_features(spark, sf):
    columns = inputs.REGRESSION_FEATURES
    rows = features.assemble(inputs.regression(spark, sf), columns)
    return features.spread_vector(
        rows.select("l_orderkey", "l_linenumber", "features"), "features", len(columns)
    )


@query
def string_index(spark, sf):
    columns = ["o_orderpriority", "o_orderstatus"]
    indexed = features.index_categories(
        table(spark, sf, "orders").select("o_orderkey", *columns), columns
    )
    return indexed.select(
        "o_orderkey", *[F.col(f"{c}_index").cast("int").alias(f"{c}_index") for c in columns]
    )


@query
def string_index_keys(spark, sf):
    """A column with many values."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer")
    )
    indexed = features.index_categories(orders, ["customer"])
    return indexed.select("o_orderkey", F.col("customer_index").cast("int"))


@query
def one_hot(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    encoded = features.one_hot(rows, ["o_orderpriority"])
    return features.spread_vector(
        encoded.select("o_orderkey", F.col("o_orderpriority_vector")), "o_orderpriority_vector", 4
    )


@query
def pipeline_features(spark, sf):
    train, test = relational.hash_split(inputs.binary(spark, sf), "o_orderkey")
    pipeline = features.feature_pipeline(inputs.BINARY_CATEGORIES, inputs.BINARY_INPUTS)
    encoded = pipeline.fit(train).transform(test).select("o_orderkey", "label", "features")
    return features.spread_vector(encoded, "features", 10)


# --- regression ------------------------------------------------------------


@query
def linear_fit(spark, sf):
    rows = features.assemble(inputs.regression(spark, sf), ["l_quantity"])
    model = regression.fit_linear(rows.select("features", "label"))
    report = regression.linear_report(spark, model, ["l_quantity"])
    return report.select("term", *_rounded("coefficient", places=4))


@query
def linear_fit_ridge(spark, sf):
    """One feature with the middle value of the tuning grid."""
    rows = features.assemble(inputs.regression(spark, sf), ["l_quantity"])
    model = regression.fit_linear(
        rows.select("features", "label"), regParam=regression.REG_PARAMS[1]
    )
    report = regression.linear_report(spark, model, ["l_quantity"])
    return report.select("term", *_rounded("coefficient", places=4), "reg_param")


@query
def linear_fit_features(spark, sf):
    """All three features, without regularisation."""
    columns = inputs.REGRESSION_FEATURES
    rows = features.assemble(inputs.regression(spark, sf), columns)
    model = regression.fit_linear(rows.select("features", "label"))
    report = regression.linear_report(spark, model, columns)
    return report.select("term", *_rounded("coefficient", places=3))


def _price_split(spark, sf):
    rows = features.assemble(inputs.regression(spark, sf), inputs.REGRESSION_FEATURES)
    return relational.hash_split(rows, F.concat_ws("-", "l_orderkey", "l_linenumber"))


def _tuned(train: DataFrame) -> regression.Tuned:
    return regression.tune_linear(train, key=F.concat_ws("-", "l_orderkey", "l_linenumber"))


@query
def linear_tune(spark, sf):
    report = regression.tuning_report(spark, _tuned(_price_split(spark, sf)[0]))
    return report.select("reg_param", *_rounded("metric", places=4), "is_best")


@query
def linear_best_model(spark, sf):
    tuned = _tuned(_price_split(spark, sf)[0])
    report = regression.linear_report(spark, tuned.model, inputs.REGRESSION_FEATURES)
    return report.select("term", *_rounded("coefficient", places=3), "reg_param")


def _priced(train: DataFrame, test: DataFrame) -> DataFrame:
    scored = _tuned(train).transform(test)
    rows = features.spread_vector(
        scored.select("l_orderkey", "l_linenumber", "features", "label", "prediction"),
        "features",
        len(inputs.REGRESSION_FEATURES),
    )
    return rows.withColumns({"prediction": _rounded("prediction", places=3)[0]})


@query
def linear_score(spark, sf):
    return _priced(*_price_split(spark, sf))


@query
def prices_from_file(spark, sf):
    """From a file with a header to scored prices: types from the file, features,
    split, tuning, scores."""
    path = scratch_path(spark, "prices")
    sinks.write_csv(inputs.regression(spark, sf), path)
    rows = features.assemble(text.read_csv(spark, path), inputs.REGRESSION_FEATURES)
    return _priced(*relational.hash_split(rows, F.concat_ws("-", "l_orderkey", "l_linenumber")))


@query
def regression_metrics(spark, sf):
    rows = inputs.regression(spark, sf).withColumn("prediction", F.col("l_quantity") * 1500)
    return evaluation.regression_metrics(rows).select(*_rounded("rmse", "mse", "mae", places=2), *_rounded("r2"))


# --- classification --------------------------------------------------------


def _order_classifier(spark, sf):
    train, test = relational.hash_split(inputs.binary(spark, sf), "o_orderkey")
    model = classification.fit_logistic(train, inputs.BINARY_CATEGORIES, inputs.BINARY_INPUTS)
    return model, test


@query
def logistic_fit(spark, sf):
    report = classification.logistic_report(spark, _order_classifier(spark, sf)[0])
    return report.select("class", "position", *_rounded("coefficient", places=SOLVER_PLACES))


@query
def logistic_score(spark, sf):
    model, test = _order_classifier(spark, sf)
    scored = classification.score_logistic(model, test, ["o_orderkey", "label"])
    return scored.select("o_orderkey", "label", "prediction", *_rounded("probability", places=SOLVER_PLACES))


@query
def logistic_quality(spark, sf):
    """The labelled documents, lightly regularised, scored by label."""
    train, test = relational.hash_split(inputs.quality(spark, sf), "doc_id")
    model = classification.fit_logistic(
        train, inputs.DOCUMENT_CATEGORIES, inputs.DOCUMENT_INPUTS, reg_param=0.01, elastic_net=0.0
    )
    return classification.score_logistic(model, test, ["doc_id", "label"]).drop("probabilities")


def _cell_scores(rows: DataFrame) -> DataFrame:
    """Test rows scored by a model with a weight per cell of priority and segment,
    without a penalty: the probability of a cell is its share in the training rows."""
    cells = rows.select("o_orderkey", "label", F.concat_ws("/", "o_orderpriority", "c_mktsegment").alias("cell"))
    train, test = relational.hash_split(cells, "o_orderkey")
    model = classification.fit_logistic(
        train, ["cell"], ["cell"], max_iter=300, reg_param=0.0, elastic_net=0.0, tolerance=1e-12
    )
    # The solver leaves a cell of equal shares a hair off one half.
    probability = F.round("probability", SOLVER_PLACES)
    return classification.score_logistic(model, test, ["label"]).select(
        "label", (probability > 0.5).cast("double").alias("prediction"), probability.alias("probability")
    )


@query
def fitted_confusion(spark, sf):
    return evaluation.confusion_matrix(_cell_scores(inputs.binary(spark, sf)))


@query
def fitted_accuracy(spark, sf):
    return evaluation.accuracy(_cell_scores(inputs.binary(spark, sf))).select(*_rounded("accuracy"))


@query
def fitted_roc(spark, sf):
    return evaluation.roc_curve(_cell_scores(inputs.binary(spark, sf)), score="probability")


@query
def subscriptions_from_file(spark, sf):
    """From a file with a header to the accuracy of a fitted model: types from the
    file, encoding, split, fit, scores."""
    path = scratch_path(spark, "orders")
    sinks.write_csv(inputs.binary(spark, sf), path)
    return evaluation.accuracy(_cell_scores(text.read_csv(spark, path))).select(*_rounded("accuracy"))


@query
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(inputs.fixed_rule(spark, sf))


@query
def accuracy(spark, sf):
    return evaluation.accuracy(inputs.fixed_rule(spark, sf)).select(*_rounded("accuracy"))


@query
def roc_curve(spark, sf):
    return evaluation.roc_curve(inputs.fixed_rule(spark, sf))


@query
def roc_curve_scores(spark, sf):
    """A point per distinct price: many thresholds instead of two."""
    return evaluation.roc_curve(inputs.fixed_rule(spark, sf), score="o_totalprice")
