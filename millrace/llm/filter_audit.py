"""How five filters interact, over every order of applying them.

A document fails a set of filters, its mask; only the mask matters, so the documents
of a part come down to at most 32 counts. In a given order the first filter of
the order that is in the mask removes the document. The orders that begin with
a given prefix are neighbours in lexicographic order: a prefix has a rank (its
Lehmer code in the factorial number system) and covers an interval of orders. So a
mask's removal at a step covers intervals of ranks. Counts are added where an
interval begins and taken off where it ends, and one prefix sum over the 120
ranks gives the removals of every order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
MASKS = 1 << len(FILTERS)
_SPACES = "\t\n\x0b\x0c\r"


def lehmer_rank(prefix: tuple[int, ...], n: int = len(FILTERS)) -> int:
    """Rank of the first of all orders of 0..n-1 that begin with `prefix`."""
    rank, left = 0, list(range(n))
    for place, item in enumerate(prefix):
        rank += left.index(item) * factorial(n - 1 - place)
        left.remove(item)
    return rank


@lru_cache(maxsize=1)
def removal_intervals() -> np.ndarray:
    """Rows (mask, step, first rank, end rank): the orders in which documents of a
    mask are removed at a step. Neighbouring intervals are one row."""
    rows = []
    n = len(FILTERS)
    for mask in range(1, MASKS):
        for step in range(n):
            spans: list[list[int]] = []
            for prefix in permutations(range(n), step + 1):
                if any(mask >> f & 1 for f in prefix[:-1]) or not mask >> prefix[-1] & 1:
                    continue
                first = lehmer_rank(prefix)
                end = first + factorial(n - 1 - step)
                if spans and spans[-1][1] == first:
                    spans[-1][1] = end
                else:
                    spans.append([first, end])
            rows += [(mask, step, first, end) for first, end in spans]
    return np.array(rows, dtype=np.int64)


def removed_by_rank(counts: np.ndarray) -> np.ndarray:
    """(parts, steps, ranks): documents removed, from counts (parts, masks)."""
    mask, step, first, end = removal_intervals().T
    ends = np.zeros((len(counts), len(FILTERS), ORDERS + 1), dtype=np.int64)
    np.add.at(ends, (slice(None), step, first), counts[:, mask])
    np.subtract.at(ends, (slice(None), step, end), counts[:, mask])
    return np.cumsum(ends, axis=2)[:, :, :ORDERS]


def _emit_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, cells) to 600 rows each."""
    steps = len(FILTERS)
    orders = np.array(list(permutations(range(steps))))  # lexicographic
    names = ["".join(FILTERS[f] for f in order) for order in orders]
    fails = (np.arange(MASKS)[:, None] >> np.arange(steps) & 1).astype(np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            piece = batch.slice(at, 100)
            parts = piece.num_rows
            counts = np.zeros((3, parts, MASKS), dtype=np.int64)
            for i, cells in enumerate(piece["cells"].to_pylist()):
                for c in cells:
                    counts[:, i, c["mask"]] += (c["n"], c["good"], c["toxic"])
            # From (parts, steps, ranks) to (parts, ranks, steps).
            removed, good, toxic = (removed_by_rank(c).transpose(0, 2, 1) for c in counts)
            here = orders[None].repeat(parts, axis=0).reshape(parts, -1)
            total = counts[0].sum(axis=1)[:, None, None]
            failing = np.take_along_axis(counts[0] @ fails, here, 1).reshape(removed.shape)
            alone = np.take_along_axis(counts[0][:, 1 << np.arange(steps)], here, 1)
            by_filter = np.zeros((parts, steps), dtype=np.int64)
            for f in range(steps):
                by_filter[:, f] = removed[:, orders == f].sum(axis=1)
            columns = {
                "kept": total - np.cumsum(removed, axis=2),
                "removed": removed,
                "redundant": failing - removed,
                "unique_fails": alone,
                "good_lost": good,
                "toxic_lost": toxic,
                "shapley": np.take_along_axis(by_filter, here, 1),
            }
            yield pa.RecordBatch.from_pydict(
                {
                    "part": piece["part"].take(pa.array(np.repeat(np.arange(parts), ORDERS * steps))),
                    "filter_order": pa.array(names * parts).take(pa.array(np.repeat(np.arange(parts * ORDERS), steps))),
                    "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), parts * ORDERS)),
                    **{name: pa.array(values.reshape(-1)) for name, values in columns.items()},
                }
            )


_OUT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit_masks(cells: DataFrame) -> DataFrame:
    """All orders and steps from counts (part, mask, n, good, toxic). Bit f of a
    mask stands for the filter of letter f; cells of one part may come in any
    number of rows."""
    rows = (
        cells.groupBy("part", "mask")
        .agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    )
    return rows.mapInArrow(_emit_parts, _OUT)


def text_masks(text: Column) -> Column:
    """Bits 0 to 3: fewer than 50 words; under 65 % of them distinct; over 5 %
    capitals; holds a symbol of `#$%&*|`."""
    words = F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), "")
    n, distinct = F.size(words).cast("bigint"), F.size(F.array_distinct(words)).cast("bigint")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("bigint")
    tests = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text).cast("bigint"), text.rlike("[#$%&*|]")]
    bits = [F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(tests)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts (part, mask, n, good, toxic) of `docs` (doc_id, text, source).

    Texts are compared by their 128-bit hash; equal rows are counted together
    before they move, and the smallest id of a text is a combined minimum, so a
    large group of copies is no hot key: rows meet it by text and id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_masks(text).alias("mask"),
        F.unhex(F.md5(text.cast("binary"))).alias("same"),
    )
    rows = thin.groupBy("doc_id", "part", "mask", "same").agg(F.count(F.lit(1)).alias("n"))
    firsts = (
        rows.where("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("first"))
        .select(F.col("same").alias("_same"), F.col("first").alias("_first"))
    )
    # Rows without an id have no label: their join key is spread by the text.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("same")).otherwise(F.lit(0))
    facts = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(
            F.max(F.coalesce((F.col("quality") == 1).cast("bigint"), F.lit(0))).alias("_good"),
            F.max(F.coalesce((F.col("toxic") == 1).cast("bigint"), F.lit(0))).alias("_toxic"),
        )
        .withColumn("_spread", F.lit(0).cast("bigint"))
    )
    is_first = F.col("_first").isNotNull() | F.col("doc_id").isNull()
    return (
        rows.withColumn("spread", spread)
        .join(firsts, (F.col("same") == F.col("_same")) & (F.col("doc_id") == F.col("_first")), "left")
        .join(facts, (F.col("doc_id") == F.col("_id")) & (F.col("spread") == F.col("_spread")), "left")
        .withColumn("mask", F.col("mask") + F.when(is_first, F.lit(0)).otherwise(F.lit(16)))
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("_good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("_toxic", F.lit(0))).alias("toxic"),
        )
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (`source`, NULL as ''), `filter_order` and `step`: `kept`,
    `removed`, `redundant`, `unique_fails`, `good_lost`, `toxic_lost`, `shapley`.

    Filters by letter: A fewer than 50 words, B less than 65 % distinct words, C
    more than 5 % capitals, D holds one of `#$%&*|`, E has the text of a smaller
    `doc_id`. A NULL text is empty. A row without `doc_id` never fails E, makes
    no other row fail it and has no label. Rows that share id and text are counted
    each, and neither is the smaller. Of several labels of an id any 1 counts.
    Other columns are ignored. An empty table has no parts and gives no rows.
    """
    return audit_masks(mask_counts(docs, labels))
