"""How far the sources of a language differ in their vocabulary.

The kept terms of a language form a table of counts, a column for each source.
Terms are put in the order of their counts, so that equal counts lie next to each
other, and each column is run-length encoded. For two columns the boundaries of
their runs are merged; between two boundaries both shares are constant, so their
difference is taken once and multiplied by the length. The vocabulary is cut into
blocks of neighbouring terms, whose sums add up; columns of very many sources are
paired tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER_ASCII, text_runs
from millrace.llm.components import _stored
from millrace.llm.frames import blocks_for

MIN_DOCUMENTS = 30
MOST_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
# Entries of the count table that a block of terms should hold, and columns of a tile.
BLOCK_ENTRIES = 200_000
TILE = 128
_RUN_BYTES = 8 << 20

LETTERS = np.zeros(256, dtype=bool)  # A-Z, a-z and every byte of other scripts
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(text number, term) of every term in a run of texts, in order."""
    inside = LETTERS[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # between two texts no term goes on
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.r_[False, inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False])) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    body = LOWER_ASCII[data[inside]]
    at = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    return text, pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(body))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to partial counts (lang, source, term, n, docs)."""
    for batch in batches:
        for row, end, data, offsets in text_runs(batch["text"], _RUN_BYTES):
            langs, sources = (batch[c].slice(row, end - row).dictionary_encode() for c in ("lang", "source"))
            group = np.asarray(langs.indices).astype(np.int64) * len(sources.dictionary) + np.asarray(sources.indices)
            text, terms = terms_of(data, offsets)
            if not len(text):
                continue
            terms = terms.dictionary_encode()
            width = len(terms.dictionary)
            in_text, times = np.unique(text * width + np.asarray(terms.indices), return_counts=True)
            cell, where = np.unique(group[in_text // width] * width + in_text % width, return_inverse=True)
            n = np.zeros(len(cell), dtype=np.int64)
            np.add.at(n, where, times)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": langs.dictionary.take(pa.array(cell // width // len(sources.dictionary))),
                    "source": sources.dictionary.take(pa.array(cell // width % len(sources.dictionary))),
                    "term": terms.dictionary.take(pa.array(cell % width)).cast(pa.string()),
                    "n": pa.array(n),
                    "docs": pa.array(np.bincount(where)),
                }
            )


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts) of the terms in at least `min_documents` documents
    of their language; `counts` has (source, n) of each source that has the term."""
    counted = docs.mapInArrow(_count_terms, "lang string, source string, term string, n bigint, docs bigint")
    return (
        counted.groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"),
        )
        .where(F.col("docs") >= min_documents)
        .drop("docs")
    )


def source_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, n_source, n_lang, n_terms) of every group that occurs."""
    groups = docs.select("lang", "source").distinct()
    of_source = (
        kept.select(F.col("lang").alias("_l"), F.inline("counts"))
        .groupBy("_l", F.col("source").alias("_s")).agg(F.sum("n").alias("n_source"))
    )
    of_lang = kept.groupBy(F.col("lang").alias("_lang")).agg(F.sum("total").alias("n_lang"), F.count(F.lit(1)).alias("n_terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return (
        groups.join(of_source, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
        .join(of_lang, F.col("lang") == F.col("_lang"), "left")
        .select("lang", "source", zero("n_source"), zero("n_lang"), zero("n_terms"))
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)), in whole numbers of any size."""
    scaled = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, total + SMOOTHING * terms) + 1


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array, by long division, three digits at a time."""
    whole, left = np.zeros(len(counts), dtype=np.int64), counts + SMOOTHING
    below = total + SMOOTHING * terms
    for _ in range(3):
        left = left * 1000
        whole, left = whole * 1000 + left // below, left % below
    return whole + 1


_RUNS = "lang string, block bigint, length int, source string, starts array<int>, counts array<bigint>"


def _encode_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered terms (lang, counts, part) to the run-length columns of each block."""
    number = 0
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        codes = np.asarray(langs.indices)
        lists = batch["counts"]
        first, cells = np.asarray(lists.offsets), lists.values
        cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1], True]) if len(codes) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            here = cells.slice(first[a], first[b] - first[a])
            sources = here.field("source").dictionary_encode()
            which, n = np.asarray(sources.indices), np.asarray(here.field("n"))
            at = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
            rows = []
            for s in range(len(sources.dictionary)):
                column = np.zeros(b - a, dtype=np.int64)
                column[at[which == s]] = n[which == s]
                starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
                rows.append((starts.astype(np.int32), column[starts]))
            block = (int(batch["part"][0].as_py()) << 32) + number
            number += 1
            size = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs.dictionary[int(codes[a])].as_py()] * size, pa.string()),
                    pa.array([block] * size, pa.int64()),
                    pa.array([b - a] * size, pa.int32()),
                    sources.dictionary.cast(pa.string()),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                ],
                names=["lang", "block", "length", "source", "starts", "counts"],
            )


def run_columns(kept: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The columns of every block, run-length encoded: (lang, block, length, source,
    starts, counts). Sources without a term of the block have no row."""
    entries = kept.agg(F.coalesce(F.sum(F.size("counts")), F.lit(0))).first()[0]
    return (
        kept.select("lang", "counts")
        .repartitionByRange(blocks_for(entries, block_entries), "lang", "counts")
        .sortWithinPartitions("lang", "counts")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_encode_runs, _RUNS)
    )


def _pair_sums(table: pa.Table) -> pa.Table:
    """All pairs of two tiles of one block, over the merged boundaries of their runs."""
    rows = table.select(["lang", "source", "mine", "low", "high", "length", "n_source", "n_terms", "starts", "counts"]).to_pylist()
    out = []
    for row in rows:
        if row["starts"] is None:  # no term of this block
            row["starts"], row["counts"] = ([0], [0]) if row["length"] else ([], [])
        row["starts"] = np.array(row["starts"], dtype=np.int64)
        row["shares"] = _shares(np.array(row["counts"], dtype=np.int64), row["n_source"], row["n_terms"] or 1)
    for x in rows:
        if x["mine"] != x["low"]:
            continue
        for y in rows:
            if y["mine"] != y["high"] or (x["low"] == x["high"] and x["source"] >= y["source"]):
                continue
            bounds = np.union1d(x["starts"], y["starts"])
            lengths = np.diff(np.r_[bounds, x["length"]])
            p = x["shares"][np.searchsorted(x["starts"], bounds, side="right") - 1]
            q = y["shares"][np.searchsorted(y["starts"], bounds, side="right") - 1]
            out.append((x["lang"], x["source"], y["source"], int((np.abs(p - q) * lengths).sum())))
    fields = [("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())]
    return pa.table([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], schema=pa.schema(fields))


def pair_divergence(columns: DataFrame, totals: DataFrame, tile: int = TILE) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, each pair once."""
    most = totals.groupBy("lang").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    tiles = blocks_for(most, tile)
    # A language without kept terms has one block of no terms.
    blocks = (
        columns.select("lang", "block", "length")
        .unionByName(totals.select("lang", F.lit(-1).cast("bigint").alias("block"), F.lit(0).alias("length")))
        .distinct()
    )
    runs = columns.select("lang", "block", "source", "starts", "counts")
    full = blocks.join(totals, "lang").join(runs, ["lang", "block", "source"], "left")
    mine = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    tiled = full.withColumn("mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return (
        tiled.withColumns({"low": F.least("mine", "_other"), "high": F.greatest("mine", "_other")})
        .drop("_other")
        .groupBy("lang", "block", "low", "high")
        .applyInArrow(_pair_sums, "lang string, a string, b string, value bigint")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, most_terms: int = MOST_TERMS, block_entries: int = BLOCK_ENTRIES, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank) of `docs` (text, lang, source).

    Terms are runs of letters and of anything beyond ASCII, A-Z lower-cased; a
    language keeps those in at least `min_documents` of its rows. Part 'pair' has the
    other sources of the language by the summed difference of their shares, part
    'term' the `most_terms` kept terms whose share in the source exceeds that in
    the language most. Ties go to the smaller item. NULL text, lang and source
    are ''. Repeated rows count each; other columns are ignored. A source alone in
    its language has no pairs; without kept terms all pairs have value 0. An
    empty table gives no rows.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(empty("lang"), empty("source"), empty("text"))
    kept = _stored(kept_terms(docs, min_documents), "kept-terms")
    totals = _stored(source_totals(docs, kept), "source-totals")
    columns = _stored(run_columns(kept, block_entries), "run-columns")
    pairs = pair_divergence(columns, totals, tile)
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    by_pair = _ranked(pairs.select("lang", F.inline(both), "value"))
    shares = (
        kept.select("lang", "term", "total", F.inline("counts"))
        .join(totals, ["lang", "source"])
        .select(
            "lang", "source", F.col("term").alias("item"),
            (share(F.col("n"), F.col("n_source"), F.col("n_terms")) - share(F.col("total"), F.col("n_lang"), F.col("n_terms"))).alias("value"),
        )
    )
    by_term = _ranked(shares.where("value > 0")).where(F.col("rank") <= most_terms)
    columns_out = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns_out(by_pair, "pair").unionByName(columns_out(by_term, "term"))
