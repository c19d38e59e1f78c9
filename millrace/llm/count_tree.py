"""Exact Jaccard join of texts by trees over vectors of group counts.

A document is the set of its distinct word shingles, hashed to 64 bits; equal sets
are one class, which its smallest document stands for. Tokens are hashed into
groups, and a document is the point of its counts by group. Two sets share at most
the sum, over the groups, of the smaller count; so points of linked documents
are no further apart (in summed differences) than their sets differ.

The root of the index cuts the groups into m slabs, as many for all sets of a size
class. A document whose linked partners differ from it by at most d tokens is equal
to each of them in every group of at least m - d slabs. It is filed under its d + 1
fullest slabs: the fullest that two linked documents have in common is filed by
both, or one would have left out m - d slabs, so linked documents meet. Below the root each slab has
R-trees over its documents' points, here folded to `GROUPS` groups: a node holds the
largest count of each group and the least size below it, and two nodes are
searched on only if the summed smaller counts can reach the overlap that their
sizes require. Pairs of documents that are left are bounded once more by `FINE_GROUPS`
groups. What survives is confirmed on the full sets.

Documents of one known component need no comparison. So first each document is
compared with a hub, the document that meets most others in one of its slabs; in a
group of near copies that is one close to their origin. The trees then search
slabs that still hold several components, in blocks of at most about `LEAF` documents;
those of a slab's largest component are only compared with others. A first search hands
on a forest of its pairs, no more than there are documents, so dense groups do not
multiply; a second one, when the components have grown by those that are links, hands
on all pairs that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import Words, mix, text_runs
from millrace.llm.chosen_path import _sets, _shingles
from millrace.llm.components import _stored, components
from millrace.llm.frames import blocks_for

GROUPS = 64
FINE_GROUPS = 1024  # a multiple of GROUPS
SLAB_BITS = 16
FANOUT = 16
LEAF = 512
HUB_ROUNDS = 2
HUB_SHARE = 4
# Rows a task of the tree search should hold, and pairs that share a copy of a set.
GROUP_ROWS = 20_000
PAIR_ROWS = 2_000
# A class of copies beyond this, or its share of a quarter partition, is joined in parts.
CLASS_ROWS = 2_000
_RUN_BYTES = 2 << 20


def size_bounds(percent: int, most: int) -> np.ndarray:
    """First sizes of the size classes up to `most`: linked sets are of one class
    or of neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(max(2 * bounds[-1], 100 * bounds[-1] // percent + 1))
    return np.array(bounds + [max(2 * bounds[-1], 100 * bounds[-1] // percent + 1)], dtype=np.int64)


def furthest(percent: int, total: np.ndarray) -> np.ndarray:
    """How many tokens are in one only of two linked sets of together `total`."""
    return total * (100 - percent) // (100 + percent)


def _slab_keys(doc: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the slabs under which documents are filed, in order.

    A document is filed for pairs whose larger one is in its own size class, and, if
    it may have partners there, for pairs whose larger one is in the next.
    """
    bounds = size_bounds(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(bounds, sizes, side="right") - 1
    largest = 100 * sizes // percent  # partner
    token = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    value = mix((token >> np.uint64(64 - SLAB_BITS)) + np.uint64(1))  # of the token's group in its slab
    docs, keys = [], []
    for scheme, used in ((own, sizes > 0), (own + 1, (sizes > 0) & (largest >= bounds[own + 1]))):
        within = furthest(percent, 2 * (bounds[scheme + 1] - 1))
        far = np.minimum(within, furthest(percent, sizes + largest))
        # No difference allowed: only equal sets are linked, which are one class.
        slabs = np.where(used & (far > 0), within + 2 + within // 8, 0)
        first = np.r_[0, np.cumsum(slabs)]
        live = np.flatnonzero(slabs[doc])
        d = doc[live]
        at = first[d] + ((token[live] & np.uint64(0xFFFFFFFF)).astype(np.int64) % slabs[d])
        order = np.argsort(at, kind="stable")
        held = np.bincount(at, minlength=first[-1])
        sums = np.r_[np.uint64(0), np.cumsum(value[live][order], dtype=np.uint64)]
        ends = np.cumsum(held)
        counts = sums[ends] - sums[ends - held]  # stands for the counts of the slab's groups
        owner = np.repeat(np.arange(len(sizes)), slabs)
        place = np.arange(first[-1]) - first[owner]
        fewest = np.lexsort((place, held, owner))
        rank = np.empty(first[-1], dtype=np.int64)
        rank[fewest] = np.arange(first[-1]) - first[owner]
        kept = rank >= (slabs - far - 1)[owner]
        name = mix((scheme[owner].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64))
        docs.append(owner[kept])
        keys.append(mix(counts[kept] + name[kept]))
    docs, keys = np.concatenate(docs), np.concatenate(keys)
    order = np.argsort(docs, kind="stable")
    return docs[order], keys[order]


_FEATURES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64())), ("point", pa.binary())]
)


def _packed(doc: np.ndarray, group: np.ndarray, docs: int) -> list[bytes]:
    """Points of each document: a byte for each fine group, and what the counts are
    together above 255. The excess is a group like others: counts and excess give
    no smaller bound than the whole counts."""
    out = []
    first = np.searchsorted(doc, np.arange(docs + 1))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        counts = np.bincount(group[a:b], minlength=FINE_GROUPS)
        low = np.minimum(counts, 255)
        out.append(low.astype(np.uint8).tobytes() + np.array([(counts - low).sum()], "<u4").tobytes())
    return out


def _unpacked(points: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fine counts, excess, coarse points with the excess as last group)."""
    rows = np.frombuffer(b"".join(points), dtype=np.uint8).reshape(len(points), FINE_GROUPS + 4)
    fine = rows[:, :FINE_GROUPS]
    excess = np.ascontiguousarray(rows[:, FINE_GROUPS:]).view("<u4").astype(np.int64).ravel()
    coarse = fine.reshape(len(points), -1, GROUPS).sum(axis=1, dtype=np.int64)
    return fine, excess, np.column_stack([coarse, excess])


def _features(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_runs(batch["text"], _RUN_BYTES):
                docs = end - row
                doc, hashes = _shingles(Words(data, offsets, lower=True), size)
                first = np.searchsorted(doc, np.arange(docs + 1))
                sizes = np.diff(first)
                filled = np.flatnonzero(sizes)
                sums = np.zeros((2, docs), dtype=np.uint64)
                if len(filled):
                    sums[0, filled] = np.add.reduceat(mix(hashes + np.uint64(1)), first[:-1][filled])
                    sums[1, filled] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[:-1][filled])
                group = (mix(hashes + np.uint64(7)) % np.uint64(FINE_GROUPS)).astype(np.int64)
                points = _packed(doc, group, docs)
                owner, keys = _slab_keys(doc, hashes, sizes, percent)
                at = np.searchsorted(owner, np.arange(docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, docs).cast(pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                        *[pa.array(s.view(np.int64)) for s in sums],
                        pa.ListArray.from_arrays(pa.array(at), pa.array(keys.view(np.int64))),
                        pa.array(points, pa.binary()),
                    ],
                    schema=_FEATURES,
                )

    return run


class _Tree:
    """An R-tree over points, packed in their given order: per level the largest
    counts, least size, and smallest and largest component of each node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, names: np.ndarray, height: int):
        self.levels = [(points, sizes, names, names)]
        for _ in range(height):
            most, least, low, high = self.levels[-1]
            cuts = np.arange(0, len(most), FANOUT)
            self.levels.append(
                (np.maximum.reduceat(most, cuts), np.minimum.reduceat(least, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts))
            )

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `nodes`, child) of all children, which are on `level`."""
        first = nodes * FANOUT
        counts = np.minimum(first + FANOUT, len(self.levels[level][0])) - first
        of = np.repeat(np.arange(len(nodes)), counts)
        return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def tree_join(left: _Tree, right: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points that the bound allows and that are not of one component."""
    top = len(left.levels) - 1
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(left.levels[top][0])), np.arange(len(right.levels[top][0])), indexing="ij"))
    for level in range(top, -1, -1):
        if level < top:
            of, a = left.children(level, a)
            of2, b = right.children(level, b[of])
            a = a[of2]
        most, least, low, high = left.levels[level]
        most2, least2, low2, high2 = right.levels[level]
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            shared = np.minimum(most[x], most2[y]).sum(axis=1, dtype=np.int64)
            several = (np.minimum(low[x], low2[y]) < np.maximum(high[x], high2[y]))
            keep[at : at + (1 << 16)] = several & ((100 + percent) * shared >= percent * (least[x] + least2[y]))
        a, b = a[keep], b[keep]
    return a, b


def _find(parent: dict[int, int], x: int) -> int:
    while parent.get(x, x) != x:
        parent[x] = x = parent.get(parent[x], parent[x])
    return x


def _forest(pairs: np.ndarray, named: dict[int, int]) -> np.ndarray:
    """As many of the pairs as join all components that the pairs join."""
    parent: dict[int, int] = {}
    kept = []
    for i, (a, b) in enumerate(pairs.tolist()):
        a, b = _find(parent, named[a]), _find(parent, named[b])
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return pairs[kept]


def _search(percent: int, forest: bool):
    """Rows (task, id, component, n, point, left, right) to candidate pairs (a, b); with
    `forest` no more than would join all their components, were they all links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("task", "ascending"), ("n", "ascending"), ("id", "ascending")]).combine_chunks()
        task, ids, names, sizes = (np.asarray(table[c]) for c in ("task", "id", "component", "n"))
        in_left, in_right = (np.asarray(table[c]) for c in ("left", "right"))
        fine, excess, points = _unpacked(table["point"].to_pylist())
        cuts = np.flatnonzero(np.r_[True, task[1:] != task[:-1], True])
        found = [np.zeros((0, 2), dtype=np.int64)]
        for first, end in zip(cuts[:-1], cuts[1:]):
            sides = [first + np.flatnonzero(s[first:end]) for s in (in_left, in_right)]
            if not all(map(len, sides)) or (names[first:end] == names[first]).all():
                continue
            height = 0
            while FANOUT ** (height + 1) < max(map(len, sides)):
                height += 1
            trees = [_Tree(points[s], sizes[s], names[s], height) for s in sides]
            a, b = tree_join(*trees, percent)
            a, b = sides[0][a], sides[1][b]
            near = np.zeros(len(a), dtype=bool)
            for at in range(0, len(a), 1 << 12):
                x, y = a[at : at + (1 << 12)], b[at : at + (1 << 12)]
                shared = np.minimum(fine[x], fine[y]).sum(axis=1, dtype=np.int64) + np.minimum(excess[x], excess[y])
                near[at : at + (1 << 12)] = (100 + percent) * shared >= percent * (sizes[x] + sizes[y])
            a, b = ids[a[near]], ids[b[near]]
            found.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0))
        pairs = np.unique(np.concatenate(found), axis=0)
        if forest:
            pairs = _forest(pairs, dict(zip(ids.tolist(), names.tolist())))
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return run


class _Join:
    def __init__(self, docs: DataFrame, tokens: DataFrame, links: DataFrame, size: int, percent: int, leaf: int):
        self.percent, self.leaf = percent, leaf
        self.tokens = tokens
        self.links = links
        self.names = components(links)
        filed = tokens.select("id", F.explode("keys").alias("key"))
        meet = filed.groupBy("key").count().where("count > 1")
        self.filed = _stored(filed.join(meet.select("key"), "key"), "slabs")
        wanted = self.filed.select(F.col("id").alias("doc_id")).distinct()
        chosen = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
        self.sets = _stored(chosen.mapInArrow(_sets(size), "id bigint, shingles array<bigint>").distinct(), "sets")

    def open_slabs(self, share: int = 1) -> DataFrame:
        """(key, id, component) of slabs that hold several components; of a share of
        the slabs, which is enough to find hubs."""
        names = self.names.withColumnRenamed("id", "_id")
        filed = self.filed.where(F.pmod("key", F.lit(share)) == 0) if share > 1 else self.filed
        rows = filed.join(names, F.col("id") == F.col("_id"), "left").select(
            "key", "id", F.coalesce("component", "id").alias("component")
        )
        several = rows.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high")
        return _stored(rows.join(several.select("key"), "key"), "open")

    def hub_pairs(self, rows: DataFrame) -> DataFrame:
        """(a, b): each document b with the hub a of one of its slabs."""
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        scores = rows.join(sizes, "key").groupBy("id").agg(F.sum("size").alias("score"))
        best = F.max(F.struct("score", (-F.col("id")).alias("order"), "component")).alias("hub")
        hubs = rows.join(scores, "id").groupBy("key").agg(best)
        return (
            rows.join(hubs, "key")
            .where("component <> hub.component")
            .groupBy(F.col("id").alias("b"))
            .agg(F.max("hub").alias("hub"))
            .select((-F.col("hub.order")).alias("a"), "b")
        )

    def tree_pairs(self, rows: DataFrame, forest: bool) -> DataFrame:
        """(a, b): pairs of different components that the trees leave over, or a forest
        of them.

        Per slab, blocks of documents outside the largest component meet each other,
        and blocks of that component.
        """
        by_name = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
        shape = by_name.groupBy("key").agg(F.sum("_n").alias("_all"), F.max(F.struct("_n", "component")).alias("_main"))
        blocks = lambda n: F.ceil(n / self.leaf).cast("int")
        shape = shape.select(
            "key",
            F.col("_main.component").alias("_name"),
            blocks(F.col("_main._n")).alias("mains"),
            blocks(F.col("_all") - F.col("_main._n")).alias("others"),
        )
        placed = rows.join(shape, "key").withColumn("is_main", F.col("component") == F.col("_name"))
        placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        task = lambda i, j: F.xxhash64("key", i, j).alias("task")
        yes, no = F.lit(True), F.lit(False)
        main = placed.where("is_main").withColumn("_i", F.explode(upto(F.col("others"))))
        main = main.select("id", "component", task(F.col("_i"), F.col("own")), no.alias("left"), yes.alias("right"))
        other = placed.where("not is_main")
        to_main = other.withColumn("_j", F.explode(upto(F.col("mains")))).select(
            "id", "component", task(F.col("own"), F.col("_j")), yes.alias("left"), no.alias("right")
        )
        among = other.withColumn("_j", F.explode(upto(F.col("others"))))
        among = among.select(
            "id", "component",
            task(F.least("own", "_j"), F.col("mains") + F.greatest("own", "_j")),
            (F.col("own") <= F.col("_j")).alias("left"),
            (F.col("own") >= F.col("_j")).alias("right"),
        )
        work = _stored(main.unionByName(to_main).unionByName(among), "tree-rows")
        groups = blocks_for(work.count(), GROUP_ROWS)
        points = self.tokens.select(F.col("id").alias("_id"), "n", "point").distinct()
        return (
            work.join(points, F.col("id") == F.col("_id"))
            .drop("_id")
            .withColumn("_group", F.pmod(F.col("task"), F.lit(groups)))
            .groupBy("_group")
            .applyInArrow(_search(self.percent, forest), "a bigint, b bigint")
        )

    def confirm(self, pairs: DataFrame) -> None:
        """Compare the full sets of the pairs and extend links and components. A
        document in very many pairs as `a` is copied for every part of them."""
        pairs = _stored(pairs.distinct(), "pairs")
        count = pairs.count()
        if not count:
            return
        pairs = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(blocks_for(count, PAIR_ROWS))))
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
        both = F.size(F.array_intersect("of_a", "of_b"))
        found = (
            pairs.join(right, "b")
            .join(pairs.select("a", "part").distinct().join(left, "a"), ["a", "part"])
            .where(100 * both >= self.percent * (F.size("of_a") + F.size("of_b") - both))
            .select("a", "b")
        )
        found = _stored(found, "found")
        if not found.isEmpty():
            self.links = self.links.unionByName(found)
            self.names = components(self.links)


def _joined_by_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """`rows` with their class (n, f1, f2, size, ...). A class of very many copies is
    joined in parts; there are few such classes, since each holds its share of all rows."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(CLASS_ROWS, rows.count() // (4 * partitions))
    parts = F.ceil(F.col("size") / limit).cast("int")
    large = classes.where(F.col("size") > limit).select(*[F.col(c).alias(f"_{c}") for c in ("n", "f1", "f2")], parts.alias("_parts"))
    same = (F.col("n") == F.col("_n")) & (F.col("f1") == F.col("_f1")) & (F.col("f2") == F.col("_f2"))
    spread = rows.join(F.broadcast(large), same, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int"), F.lit(0))
    )
    copied = classes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.when(F.col("size") > limit, parts).otherwise(1) - 1)))
    return spread.drop("_n", "_f1", "_f2", "_parts").join(copied, ["n", "f1", "f2", "_part"]).drop("_part")


def jaccard_join(docs: DataFrame, shingle: int = 5, percent: int = 80, leaf: int = LEAF) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): `doc_id`, `n_shingles` and
    `component_id`, the smallest `doc_id` reachable over links.

    Texts are lower-cased (A-Z), words are runs of `[^\\x20\\x09-\\x0D]`. Two
    documents are linked if 100 * intersection >= percent * union of their sets of
    `shingle` words; the join is exact. A text with fewer words is one shingle; NULL
    or empty texts have none and are linked with nothing. A row without `doc_id` is
    linked with nothing and has a NULL component. Rows that share a `doc_id` are one
    document, whose links are those of any of them. Other columns are ignored. An
    empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    features = _stored(
        docs.mapInArrow(_features(shingle, percent), "doc_id bigint, n bigint, f1 bigint, f2 bigint, keys array<bigint>, point binary"),
        "points",
    )
    known = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    rows = features.where(known).select("doc_id", "n", "f1", "f2")
    classes = _stored(
        rows.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("size")), "classes"
    )
    # Ids with several texts link the classes of their texts.
    one = F.struct("n", "f1", "f2")
    mixed = rows.groupBy("doc_id").agg(F.min(one).alias("_low"), F.max(one).alias("_high")).where("_low <> _high").select("doc_id")
    mixed = rows.join(mixed, "doc_id", "left_semi").distinct().join(classes.select("n", "f1", "f2", "id"), ["n", "f1", "f2"])
    links = _stored(mixed.select(F.least("id", "doc_id").alias("a"), F.greatest("id", "doc_id").alias("b")).where("a <> b"), "mixed")
    tokens = (
        features.where(known)
        .join(classes.select("n", "f1", "f2", F.col("id").alias("doc_id")), ["n", "f1", "f2", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("id"), "n", "keys", "point")
    )
    join = _Join(docs, _stored(tokens, "tokens"), links, shingle, percent, leaf)
    for _ in range(HUB_ROUNDS):
        join.confirm(join.hub_pairs(join.open_slabs(HUB_SHARE)))
    for forest in (True, False):
        join.confirm(join.tree_pairs(join.open_slabs(), forest))
    names = join.names.withColumnRenamed("id", "_id")
    named = classes.join(names, F.col("id") == F.col("_id"), "left").select(
        "n", "f1", "f2", "size", F.coalesce("component", "id").alias("component_id")
    )
    linked = _joined_by_class(rows, named).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    others = features.where(~known).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(others)
