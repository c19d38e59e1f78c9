"""Near duplicates by a chosen-path set similarity join.

A document is the set of its distinct word shingles, hashed to 64 bits; equal
sets are one class, and only its smallest document goes on. Every set has
`COORDINATES` minwise tokens. A tree node is a path of such tokens: at each node
one token, or by chance two (1 / threshold on average), are chosen, and a
document goes to the child that its own minwise token names. Similar documents
meet in some node of most trees; `TREES` independent trees make a miss of a pair
at the threshold a matter of 1 in 100,000 or less.

Nodes are compared from depth `START` on. Within a node documents of one known
component need no comparison, so most of a large group of copies costs a comparison
with a hub, not all its pairs. Step 1 is done for `FIRST_TREES` trees, then for all:

1. Each document is compared with the hub of one of its nodes, the member that
   shares nodes with most others.
2. Nodes that still hold several components: those of at most `LEAF` members are
   compared exhaustively; larger ones with their hub, and then their documents
   branch down to `DEEPEST`, all levels at once. Below a large node the first nodes
   of at most `LEAF` members are compared exhaustively; what is still larger at
   `DEEPEST` with its hub, and then exhaustively in pairs of blocks of `LEAF` members.

A row is a document in a node. Rows pass one join on their node at `START` and one below
it; a document's rows are added up by a window over its id, of which it has a few dozen at
most, and its minwise tokens are joined with it once, not with each of its rows.

Before sets are compared, 64-bit sketches (one bit per minwise token) drop pairs that are
far off (6 standard deviations), and with them the members of a node that no other may
be linked with; sets of no such pair are not moved. All links are confirmed on the full
sets; a task reports only links that join components, so dense groups do not multiply.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import Words, mix, span_hashes, text_runs, tidy, tidy_group
from millrace.llm.components import _stored, components
from millrace.llm.frames import blocks_for

COORDINATES = 64
TREES = 12
# Trees whose documents meet hubs before any other is looked at: they join most of what
# is to be joined, and most nodes of large groups of copies hold one component then.
FIRST_TREES = 3
START = 3
DEEPEST = 6
LEAF = 512
# Rows that a task compares at once, in whole block pairs.
GROUP_ROWS = 2000
# Block pairs of more rows are grouped by themselves, so no group of copies is a hot key.
FEW_ROWS = 32
# The rows of a group without sets, when only sketches are compared.
SKETCH_ROWS = 20_000
# Ids up to this many (16 MB) are broadcast to pick documents; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
# Documents that branch side by side below large nodes, where each is in many.
BELOW_ROWS = 2000
_RUN_BYTES = 1 << 18


def _shingles(run: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash), sorted and distinct, of all shingles of a run of texts."""
    at, hashes = run.windows(size)
    doc = np.searchsorted(run.first, at, side="right") - 1
    counts = np.diff(run.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = span_hashes(run.hashes(), run.first[short], run.first[short + 1], 0)
    doc, hashes = np.r_[doc, short], np.r_[hashes, whole]
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


_FEATURES = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("sketch", pa.int64()), ("minwise", pa.binary())]
)


def _features(size: int):
    steps = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_runs(batch["text"], _RUN_BYTES):
                n = end - row
                doc, hashes = _shingles(Words(data, offsets, lower=True), size)
                first = np.searchsorted(doc, np.arange(n + 1))
                filled = np.flatnonzero(np.diff(first))
                cuts = first[:-1][filled]
                sums = np.zeros((2, n), dtype=np.uint64)
                minwise = np.zeros((n, COORDINATES), dtype=np.uint32)
                if len(filled):
                    sums[0, filled] = np.add.reduceat(mix(hashes + np.uint64(1)), cuts)
                    sums[1, filled] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), cuts)
                    for c in range(COORDINATES):
                        value = ((hashes ^ (hashes >> steps[COORDINATES + c] % np.uint64(31))) * steps[c]) >> np.uint64(32)
                        minwise[filled, c] = np.minimum.reduceat(value.astype(np.uint32), cuts)
                bits = (mix(minwise.astype(np.uint64)) & np.uint64(1)) << np.arange(COORDINATES, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, n).cast(pa.int64()),
                        pa.array(np.diff(first)),
                        *[pa.array(s.view(np.int64)) for s in sums],
                        pa.array(np.bitwise_or.reduce(bits, axis=1).view(np.int64)),
                        pa.array([m.tobytes() for m in minwise], pa.binary()),
                    ],
                    schema=_FEATURES,
                )

    return run


def _children(rows: np.ndarray, paths: np.ndarray, minwise: np.ndarray, threshold: float):
    """Rows and paths one level deeper: one child per chosen minwise token."""
    out_rows, out_paths = [], []
    chance = mix(paths)
    usual = int(1 / threshold)
    more = 1 / threshold - usual
    taken = chance % np.uint64(COORDINATES)
    for j in range(usual + 1):
        chosen = np.ones(len(paths), bool) if j < usual else (mix(chance) >> np.uint64(11)) < np.uint64(more * 2**53)
        coordinate = (taken + np.uint64(j) * (np.uint64(1) + mix(chance + np.uint64(j)) % np.uint64(COORDINATES - 1))) % np.uint64(COORDINATES)
        token = minwise[rows[chosen], coordinate[chosen].astype(np.int64)].astype(np.uint64)
        out_rows.append(rows[chosen])
        out_paths.append(mix(paths[chosen] * np.uint64(0xD1B54A32D192ED03) + mix(token | coordinate[chosen] << np.uint64(32))))
    return np.concatenate(out_rows), np.concatenate(out_paths)


_NODES = "node bigint, id bigint, n bigint, sketch bigint"


def _minwise(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.frombuffer(m, np.uint32) for m in batch["minwise"].to_pylist()])


def _branch(threshold: float, levels: int, trees: range):
    """The nodes of each document `levels` below the roots of `trees`."""
    schema = pa.schema([(f, pa.int64()) for f in ("node", "id", "n", "sketch")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            minwise, n = _minwise(batch), batch.num_rows
            roots = mix(np.arange(trees.start + 1, trees.stop + 1, dtype=np.uint64))
            rows, paths = np.tile(np.arange(n), len(trees)), np.repeat(roots, n)
            for _ in range(levels):
                rows, paths = _children(rows, paths, minwise, threshold)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths.view(np.int64)), *[batch[c].take(take) for c in ("id", "n", "sketch")]], schema=schema
            )

    return run


_BELOW = "node bigint, parent bigint, level int, id bigint, n bigint, sketch bigint"


def _below(threshold: float, levels: int):
    """The nodes of each document on each of the `levels` below its `nodes`."""
    schema = pa.schema([("node", pa.int64()), ("parent", pa.int64()), ("level", pa.int32()), *[(f, pa.int64()) for f in ("id", "n", "sketch")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, BELOW_ROWS) for i in range(0, whole.num_rows, BELOW_ROWS)):
                minwise, nodes = _minwise(batch), batch["nodes"]
                rows = np.repeat(np.arange(batch.num_rows), np.asarray(nodes.value_lengths()))
                paths = np.asarray(nodes.flatten()).view(np.uint64)
                for level in range(1, levels + 1):
                    # Which row a child comes from travels with it, for its parent's name.
                    place, deeper = _children(np.arange(len(rows)), paths, minwise[rows], threshold)
                    parents, rows, paths = paths[place], rows[place], deeper
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(paths.view(np.int64)),
                            pa.array(parents.view(np.int64)),
                            pa.array(np.full(len(rows), level, dtype=np.int32)),
                            *[batch[c].take(take) for c in ("id", "n", "sketch")],
                        ],
                        schema=schema,
                    )

    return run


def _sets(size: int):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_runs(batch["text"], _RUN_BYTES):
                doc, hashes = _shingles(Words(data, offsets, lower=True), size)
                first = np.searchsorted(doc, np.arange(end - row + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(row, end - row).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(first), pa.array(hashes.view(np.int64)))],
                    schema=schema,
                )

    return run


def _find(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _links(ids, names, left, right, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join different components among the members of one block pair."""
    parent = {n: n for n in names}
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    holders = owner[order]  # by token
    first = np.searchsorted(token[order], np.arange(token.max() + 2))
    edges = np.r_[0, np.cumsum(sizes)]
    for i in range(len(sets)):
        if right[i]:
            continue
        own = token[edges[i] : edges[i + 1]]
        shared = np.bincount(
            np.concatenate([holders[a:b] for a, b in zip(first[own].tolist(), first[own + 1].tolist())]), minlength=len(sets)
        )
        linked = 100 * shared >= percent * (sizes[i] + sizes - shared)
        for j in np.flatnonzero(linked & right if left[i] else linked).tolist():
            a, b = _find(parent, names[i]), _find(parent, names[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield ids[i], ids[j]


def _compare(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(rows: pa.Table, loaded: pa.Table) -> pa.Table:
        if not rows.num_rows or not loaded.num_rows:
            return schema.empty_table()
        loaded = loaded.sort_by("id").combine_chunks()
        lists = loaded["shingles"].chunk(0)
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
        table = rows.sort_by([("pair", "ascending"), ("id", "ascending")])
        # A document whose id several rows share has a set for each of them.
        first, end = (np.searchsorted(np.asarray(loaded["id"]), np.asarray(table["id"]), side=x) for x in ("left", "right"))
        many = end - first
        table = table.take(pa.array(np.repeat(np.arange(len(many)), many)))
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - first, many)
        pairs = np.asarray(table["pair"])
        cuts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1], True])
        ids, names = np.asarray(table["id"]), np.asarray(table["component"])
        left, right = (np.asarray(table[c]) for c in ("left", "right"))
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if (names[a:b] == names[a]).all():
                continue
            sets = [values[offsets[k] : offsets[k + 1]] for k in at[a:b].tolist()]
            found += _links(ids[a:b].tolist(), names[a:b].tolist(), left[a:b], right[a:b], sets, percent)
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return run


_ROWS = ("node", "id", "n", "sketch", "component", "size")
_KEYED = "pair bigint, left boolean, right boolean, id bigint, component bigint, least bigint"


def _with_partner(percent: int, most_bits: int):
    """Rows of block pairs that some row of another component may be linked with, by
    size and sketch; with the smallest id of their block pair, or where it has many
    rows its own number."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pair").combine_chunks()
        pairs = np.asarray(table["pair"])
        cuts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1], True])
        sizes, names = np.asarray(table["n"]), np.asarray(table["component"])
        sketches = np.asarray(table["sketch"]).view(np.uint64)
        left, right = (np.asarray(table[c]) for c in ("left", "right"))
        ids, keep, least = np.asarray(table["id"]), np.zeros(len(pairs), dtype=bool), np.zeros(len(pairs), dtype=np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            across = left[a:b].any() or right[a:b].any()
            n, name, sketch = sizes[a:b], names[a:b], sketches[a:b]
            for i in range(a, b):
                if right[i]:
                    continue
                near = (name != names[i]) & (100 * np.minimum(n, sizes[i]) >= percent * np.maximum(n, sizes[i]))
                if across:
                    near &= right[a:b]
                near &= np.bitwise_count(sketch ^ sketches[i]) <= most_bits
                keep[a:b] |= near
                keep[i] |= near.any()
            few = np.count_nonzero(keep[a:b]) <= FEW_ROWS
            least[a:b] = ids[a:b][keep[a:b]].min(initial=np.iinfo(np.int64).max) if few else pairs[a]
        rows = table.select(["pair", "left", "right", "id", "component"]).append_column("least", pa.array(least))
        return rows.filter(pa.array(keep))

    return run


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        agree = (1 + percent / 100) / 2
        self.most_bits = math.ceil(COORDINATES * (1 - agree) + 6 * math.sqrt(COORDINATES * agree * (1 - agree)))
        self.links: DataFrame | None = None
        self.names: DataFrame | None = None
        self.sets: DataFrame | None = None
        self.loaded: DataFrame | None = None

    def near(self, x: str, y: str):
        """Sizes and sketches of the two sides allow the threshold."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & (
            F.bit_count(F.col(f"{x}.sketch").bitwiseXOR(F.col(f"{y}.sketch"))) <= self.most_bits
        )

    def named(self, nodes: DataFrame) -> DataFrame:
        """Node rows with the component known so far."""
        if self.names is None:
            return nodes.withColumn("component", F.col("id"))
        names = self.names.withColumnRenamed("id", "_id")
        return nodes.join(names, nodes.id == names._id, "left").select(
            *nodes.columns, F.coalesce("component", "id").alias("component")
        )

    def totals(self, rows: DataFrame, *more: Column) -> DataFrame:
        """Size and members of each node that holds several components. Totals are
        combined before the shuffle."""
        totals = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.min("id").alias("low"),
            F.max("id").alias("high"),
            F.bit_xor(F.xxhash64("id")).alias("mark"),
            *more,
        )
        return totals.where("least < most")

    def rows_of(self, rows: DataFrame, totals: DataFrame) -> DataFrame:
        """Rows of the nodes in `totals`, with the node's size. Of nodes with the same
        members one is enough."""
        once = totals.groupBy("size", "low", "high", "mark").agg(F.min("node").alias("node"))
        return _stored(rows.join(once.select("node", "size"), "node").select(*_ROWS), "nodes")

    def open_nodes(self, nodes: DataFrame) -> DataFrame:
        """Rows of nodes that hold several components, with the node's size."""
        rows = self.named(nodes)
        return self.rows_of(rows, self.totals(rows))

    def still_open(self, rows: DataFrame) -> DataFrame:
        """Of opened rows, those of nodes that hold several components now. A node keeps
        all its members or is closed, so sizes stay."""
        rows = self.named(rows.drop("component"))
        ends = rows.groupBy("node").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        return _stored(rows.join(ends.where("least < most").select("node"), "node", "left_semi").select(*_ROWS), "open")

    def nodes_below(self, large: DataFrame, tokens: DataFrame, leaf: int, levels: int) -> DataFrame:
        """Rows of the first nodes below large ones that hold at most `leaf` members, and
        of larger ones on the last level; with the node's size."""
        # One row per document, so its tokens are not repeated for each of its nodes.
        lists = large.groupBy("id").agg(F.collect_list("node").alias("nodes"))
        deeper = tokens.join(lists, "id").select("id", "n", "sketch", "minwise", "nodes")
        rows = self.named(_stored(deeper.mapInArrow(_below(self.percent / 100, levels), _BELOW), "below"))
        totals = _stored(self.totals(rows, F.min("parent").alias("parent"), F.min("level").alias("level")), "totals")
        above = totals.where(F.col("size") > leaf).select(F.col("node").alias("_above"))
        ends = totals.where((F.col("size") <= leaf) | (F.col("level") == levels))
        first = ends.join(above, ends.parent == above._above, "left").where("level = 1 or _above is not null")
        return self.rows_of(rows, first)

    def with_hub(self, rows: DataFrame) -> DataFrame:
        """(a, b, score): each row's document b and the hub a of its node, where they
        may be linked. A hub is the member that shares nodes with most others, which
        in a group of near copies is one close to their common origin."""
        # A window, since a document has few rows: no join repeats them.
        scored = rows.withColumn("score", F.sum("size").over(Window.partitionBy("id")))
        best = F.max(F.struct("score", (-F.col("id")).alias("_order"), "id", "n", "sketch", "component")).alias("hub")
        hubs = scored.groupBy("node").agg(best).select("node", "hub.*").alias("y")
        return (
            rows.alias("x")
            .join(hubs, F.col("x.node") == F.col("y.node"))
            .where("x.component <> y.component")
            .where(self.near("x", "y"))
            .select(F.col("y.id").alias("a"), F.col("x.id").alias("b"), "y.score")
        )

    def compare(self, rows: DataFrame) -> None:
        """Compare all members of each node across components, in blocks of at most
        about `LEAF` members, and extend the links. A block pair of a node is compared
        within one task, which reports no more links than join its components."""
        wide = rows.withColumn("_blocks", F.ceil(F.col("size") / LEAF).cast("int"))
        own = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
        keyed = wide.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
        keyed = keyed.select(
            F.xxhash64("node", low, high).alias("pair"),
            (F.col("_own") < F.col("_other")).alias("left"),
            (F.col("_own") > F.col("_other")).alias("right"),
            "id",
            "component",
            "n",
            "sketch",
        )
        total = wide.agg(F.coalesce(F.sum(F.col("_blocks").cast("bigint")), F.lit(0))).first()[0]
        near = (
            keyed.withColumn("_group", F.pmod(F.col("pair"), F.lit(blocks_for(total, SKETCH_ROWS))))
            .groupBy("_group")
            .applyInArrow(tidy_group(_with_partner(self.percent, self.most_bits)), _KEYED)
        )
        keyed = _stored(near, "keyed")
        groups = blocks_for(keyed.count(), GROUP_ROWS)
        # Many block pairs share a group, and those with the same smallest id do, which are
        # mostly of the same documents: a group gets the set of each of its documents once.
        by_least = keyed.withColumn("_group", F.pmod(F.xxhash64("least"), F.lit(groups)))
        wanted = by_least.select(F.col("_group").alias("_part"), F.col("id").alias("_id")).distinct()
        sets = self.sets_of(keyed.select("id"))
        held = wanted.join(sets, wanted["_id"] == sets["id"]).select("_part", F.col("_id").alias("id"), "shingles")
        found = by_least.groupBy("_group").cogroup(held.groupBy("_part")).applyInArrow(
            tidy_group(_compare(self.percent)), "a bigint, b bigint"
        )
        self.extend(found)

    def confirm(self, pairs: DataFrame) -> None:
        """Compare the full sets of the pairs and extend the links and components."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = _stored(ordered.distinct(), "pairs")
        if pairs.isEmpty():
            return
        left, right = (
            self.sets_of(pairs.select(F.col(x).alias("id"))).select(F.col("id").alias(x), F.col("shingles").alias(f"of_{x}"))
            for x in ("a", "b")
        )
        both = F.size(F.array_intersect("of_a", "of_b"))
        found = (
            pairs.join(right, "b")
            .join(left, "a")
            .where(100 * both >= self.percent * (F.size("of_a") + F.size("of_b") - both))
            .select("a", "b")
        )
        self.extend(found)

    def extend(self, found: DataFrame) -> None:
        found = _stored(found, "found")
        self.links = found if self.links is None else self.links.unionByName(found)
        if not found.isEmpty():
            self.names = components(self.links)

    def load_sets(self, rows: DataFrame) -> None:
        """The full sets of all documents that share a node, of those not loaded
        before; deeper nodes hold no others."""
        ids = rows.select(F.col("id").alias("doc_id")).distinct()
        if self.loaded is not None:
            ids = ids.join(self.loaded, "doc_id", "left_anti")
        ids = _stored(ids, "ids")
        self.loaded = ids if self.loaded is None else self.loaded.unionByName(ids)
        chosen = self.docs.select("doc_id", "text").join(_broadcast_few(ids), "doc_id", "left_semi")
        sets = _stored(chosen.mapInArrow(tidy(_sets(self.size)), "id bigint, shingles array<bigint>"), "sets")
        self.sets = sets if self.sets is None else self.sets.unionByName(sets)

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """The full sets of some documents; sets of others are not moved."""
        return self.sets.join(_broadcast_few(ids.distinct()), "id", "left_semi")

    def meet_hubs(self, rows: DataFrame) -> None:
        """Compare each document with the hub of one of its nodes."""
        if not rows.isEmpty():
            self.load_sets(rows)
            self.confirm(self.with_hub(rows).groupBy("b").agg(F.max_by("a", F.struct("score", -F.col("a"))).alias("a")))

    def compare_nodes(self, rows: DataFrame, tokens: DataFrame, start: int, leaf: int, deepest: int) -> None:
        """Compare what the nodes still hold of several components, and the nodes below."""
        if rows.isEmpty():
            return
        rows = self.still_open(rows)
        if deepest > start:
            self.compare(rows.where(F.col("size") <= leaf))
            rows = rows.where(F.col("size") > leaf)
            if rows.isEmpty():
                return
            self.confirm(self.with_hub(rows))
            rows = self.nodes_below(self.still_open(rows), tokens, leaf, deepest - start)
        large = rows.where(F.col("size") > leaf)
        if not large.isEmpty():
            self.confirm(self.with_hub(large))
            rows = self.still_open(rows)
        self.compare(rows)


def _broadcast_few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, trees: int = TREES, start: int = START, leaf: int = LEAF, deepest: int = DEEPEST
) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): `doc_id`, `n_shingles`,
    `component_id` (smallest `doc_id` reachable over links) and `kept`
    (`doc_id = component_id`).

    Texts are lower-cased (A-Z), words are runs of `[^\\x20\\x09-\\x0D]`. Two
    documents are linked if 100 * intersection >= percent * union of their sets
    of `shingle` words. A text with fewer words is one shingle; NULL or empty
    texts have none and are linked with nothing. A row without `doc_id` is linked
    with nothing, has a NULL component and is kept. Rows that share a `doc_id`
    are one document, whose links are those of any of them. An empty table gives
    an empty result.
    """
    docs = docs.select("doc_id", "text")
    features = _stored(
        docs.mapInArrow(
            tidy(_features(shingle)), "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sketch bigint, minwise binary"
        ),
        "features",
    )
    usable = features.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("id"))
    # Equal sets are links, a star around the smallest document of each class.
    copies = (
        usable.select("doc_id", "n_shingles", "f1", "f2")
        .join(classes, ["n_shingles", "f1", "f2"])
        .where("doc_id <> id")
        .select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    )
    join = _Join(docs, shingle, percent)
    join.links = _stored(copies, "copies")
    one_each = usable.groupBy("n_shingles", "f1", "f2").agg(F.min(F.struct("doc_id", "sketch", "minwise")).alias("first"))
    tokens = _stored(
        one_each.select(F.col("first.doc_id").alias("id"), F.col("n_shingles").alias("n"), "first.sketch", "first.minwise"), "tokens"
    )
    for some in sorted({min(FIRST_TREES, trees), trees}):
        rows = join.open_nodes(tokens.mapInArrow(_branch(percent / 100, start, range(some)), _NODES))
        join.meet_hubs(rows)
    join.compare_nodes(rows, tokens, start, leaf, deepest)
    names = components(join.links) if join.names is None else join.names
    names = names.select(F.col("id").alias("doc_id"), "component")
    return (
        features.select("doc_id", "n_shingles")
        .join(names, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without documents that are near copies of a smaller
    `doc_id`; all columns stay."""
    gone = near_duplicates(docs, **options).where("not kept").select("doc_id").distinct()
    gone = _broadcast_few(_stored(gone, "gone"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
