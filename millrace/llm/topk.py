"""Exact top-k inner products by term-at-a-time accumulation.

Vectors are integers; a dimension is a term. Candidates are dealt into blocks,
queries into groups, and each block meets each group once, by a join on the
block number. In a task, the postings of a few terms at a time (the block's candidates
with a nonzero weight) are multiplied by the queries' weights and added into a dense
array of scores. The k best of each query and block go on to a merge of at most
k rows per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import PREFIX, blocks_for, hash_block

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
# Terms whose products are added at once.
TERMS = 16
_SCORES = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable_vectors(vectors: DataFrame, scale: int = 64, vector: str = "embedding") -> DataFrame:
    """(vec_id, weights): each component as floor(scale * x), x as double. Vectors
    that are NULL or empty or hold NULL or non-finite components, and rows
    without `vec_id`, take no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0))
        .where(fine)
        .select("vec_id", F.transform(x, lambda v: F.floor(v * scale)).alias("weights"))
    )


def _dense(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    offsets = np.asarray(lists.offsets)
    counts = np.diff(offsets)
    out = np.zeros((len(counts), int(counts.max(initial=0))), dtype=np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    out[rows, np.arange(offsets[-1] - offsets[0]) - (offsets[:-1] - offsets[0])[rows]] = np.asarray(lists.flatten())
    return out


def _accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of all pairs, a few terms after the others. Floating point is used
    only where all its sums of these integers are exact."""
    terms = min(queries.shape[1], block.shape[1])
    queries, block = queries[:, :terms], block[:, :terms]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * max(terms, 1)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    queries, postings = queries.astype(kind), np.ascontiguousarray(block.T.astype(kind))
    scores = np.zeros((len(queries), len(block)), dtype=kind)
    for first in range(0, terms, TERMS):
        wanted, weights = queries[:, first : first + TERMS], postings[first : first + TERMS]
        at, some = np.flatnonzero(weights.any(axis=0)), np.flatnonzero(wanted.any(axis=1))
        if len(at) == len(block) and len(some) == len(queries):
            scores += wanted @ weights
        elif len(at) and len(some):
            scores[np.ix_(some, at)] += wanted[some] @ weights[:, at]
    return scores


def _best(k: int):
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if block.num_rows and queries.num_rows:
            block = block.sort_by("vec_id")
            vec_ids, weights = np.asarray(block["vec_id"]), _dense(block["weights"])
            query_ids, wanted = np.asarray(queries["query_id"]), _dense(queries["weights"])
            for first in range(0, len(query_ids), QUERY_ROWS):
                ids = query_ids[first : first + QUERY_ROWS]
                scores = _accumulate(wanted[first : first + QUERY_ROWS], weights)
                for q, row in zip(ids, scores):
                    other = np.flatnonzero(vec_ids != q)
                    found = row[other]
                    if len(found) > k:
                        # All that reach the k-th best score; ids ascend, so a stable sort breaks ties.
                        least = found[np.argpartition(found, len(found) - k)[len(found) - k :]].min()
                        keep = np.flatnonzero(found >= least)
                        other, found = other[keep], found[keep]
                    order = np.argsort(-found.astype(np.int64), kind="stable")[:k]
                    out[0].append(np.full(len(order), q))
                    out[1].append(vec_ids[other[order]])
                    out[2].append(found[order])
        columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        return pa.table([pa.array(c) for c in columns], schema=_SCORES)

    return run


def top_k(vectors: DataFrame, is_query, k: int = 20, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every row of
    `vectors` (vec_id, weights) for which `is_query` holds with all other rows;
    ties go to the smaller `vec_id`, fewer rows if fewer exist.

    Vectors of different lengths are compared over the shorter. Rows that share
    a `vec_id` are not compared with each other; each counts as a candidate,
    and repeated query rows give their results once. Empty tables give no rows.
    """
    block = f"{PREFIX}block"
    blocks = blocks_for(vectors.count(), block_rows)
    held = vectors.withColumn(block, hash_block(blocks, "vec_id", "weights"))
    queries = (
        vectors.where(is_query)
        .dropDuplicates(["vec_id"])
        .select(F.col("vec_id").alias("query_id"), "weights")
        .withColumn(block, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    found = queries.groupBy(block).cogroup(held.groupBy(block)).applyInArrow(
        _best(k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
