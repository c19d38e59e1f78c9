"""Token ids in ORC files, in ascending order of document id.

Ids are an integer column (run-length encoded, version 2, then compressed).
Stripes can be read in parallel; row indexes every `row_stride` rows and Bloom
filters on `doc_id` let a reader with a filter on `doc_id` skip row groups.
A document's place among all ids is kept as its place in its part of the files
plus the ids of all parts before, which only needs a total per part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import Encoder, Remembered, Splitter, by_words, byte_characters, read_file, special_tokens
from millrace.llm.components import _stored

END_ID = 1
# More than the round trip has: new words, each a call of the library, are what takes time.
REMEMBERED_BYTES = 96 << 20
RUN_BYTES = 4 << 20
_FILE = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"


@lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """Words by the model of the tokenizers library; recent ones are remembered."""
    from tokenizers import Tokenizer

    tokenize = Tokenizer.from_file(path).model.tokenize
    chars = dict(enumerate(byte_characters()))
    file = read_file(path)
    packed = [i.to_bytes(4, "little") for i in range(max(file["model"]["vocab"].values()) + 1)]

    def ids(word: str) -> bytes:
        shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(chars)
        return b"".join([packed[t.id] for t in tokenize(shown)])

    words = lambda many: list(map(ids, many))
    remembered = Remembered(by_words(Splitter(file), words), REMEMBERED_BYTES)
    return Encoder(special_tokens(file), remembered, RUN_BYTES)


def with_ends(ids: np.ndarray, ends: np.ndarray, end_id: int, width: str) -> np.ndarray:
    """The ids of texts with `end_id` as the last of each text, which ends before `ends`."""
    body = np.empty(len(ids) + len(ends), dtype=width)
    own = np.ones(len(body), dtype=bool)
    own[ends - 1] = False
    body[own] = ids
    body[ends - 1] = end_id
    return body


def binary_values(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """(cuts, numbers) of binary values without nulls, read where they lie."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    cuts = (offsets - offsets[0]) // np.dtype(width).itemsize
    body = memoryview(column.buffers()[2])[offsets[0] : offsets[-1]]
    return cuts.astype(np.int64), np.frombuffer(body, width)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = END_ID,
    stripe_bytes: int = 64 << 20,
    row_stride: int = 1000,
    false_positives: float = 0.01,
) -> None:
    """Encode every text, append `end_id`, and write the ids of all documents to
    ORC files in `folder`, ranged and sorted by `doc_id`.

    NULL and empty texts have the end id alone. Rows without `doc_id` come first;
    rows that share a `doc_id` stay, in the order of a hash of their texts. Other
    columns are not written. An empty table makes a folder without rows.
    """
    file = read_file(tokenizer_path)
    # Ids travel in two bytes each where the vocabulary allows it.
    largest = max(end_id, max(file["model"]["vocab"].values()), *special_tokens(file).values())
    width = "<u2" if largest < 1 << 16 else "<u4"
    encoded = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path)
        for batch in batches:
            for row, end, ids, offsets in encoder(batch["text"]):
                ends = offsets[1:] + np.arange(1, end - row + 1)
                body = with_ends(ids, ends, end_id, width)
                at = np.r_[0, ends * body.itemsize].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, end - row).cast(pa.int64()),
                        batch["mark"].slice(row, end - row),
                        pa.Array.from_buffers(pa.binary(), end - row, [None, pa.py_buffer(at), pa.py_buffer(body)]),
                    ],
                    schema=encoded,
                )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                cuts, values = binary_values(part["ids"], width)
                ends, counts = cuts[1:], np.diff(cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["part"],
                        pa.array(total + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values.astype(np.int32))),
                    ],
                    schema=schema,
                )
                total += int(ends[-1])

    ids = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(encode, "doc_id bigint, mark bigint, ids binary")
    # Written once, so that neither the ranges nor the sort encode or move a text.
    (
        _stored(ids, "encoded")
        .repartitionByRange(F.col("doc_id").asc(), F.col("mark").asc())
        .sortWithinPartitions(F.col("doc_id").asc(), F.col("mark").asc())
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(place, _FILE)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(false_positives))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(row_stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.compress", "ZSTD")
        .orc(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): `start` counts the ids of all documents
    before. A filter on `doc_id` prunes stripes and row groups; the totals per part
    read two integer columns."""
    rows = spark.read.schema(_FILE).orc(folder)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per part of the files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def id_checksums(rows: DataFrame) -> DataFrame:
    """Adds `ids_crc32`, the unsigned CRC-32 of the ids as little-endian unsigned
    32-bit integers; drops `ids`."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            offsets = np.asarray(ids.offsets)
            body = np.asarray(ids.values).astype("<i4", copy=False)
            sums = [zlib.crc32(body[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(sums, pa.int64())], schema=schema
            )

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
