"""Removal of passages that an earlier document already has.

Every window of `length` words is hashed (Rabin-Karp) and counted. The texts are
dealt into chunks by document id, and hashes into buckets:

1. A chunk sends each bucket its distinct 40-bit hashes, once however often it
   holds them, so a passage in a third of all documents costs a bucket one entry
   per chunk. The bucket answers with a bit per entry: another chunk has it too.
2. For windows so marked, or held by several documents of the chunk, the chunk
   sends 128 bits of hashes with the smallest document id. The bucket answers
   with a bit per entry: another chunk has it in a smaller document.
3. The chunk marks the words of such windows and of windows that a smaller
   document of its own has, and merges them into maximal intervals.

All three steps read one exchange of the texts (the planner reuses it); only
packed hashes and bits travel otherwise. Words are runs of `[^\\x20\\x09-\\x0D]`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import Words, text_runs, tidy_group
from millrace.llm.frames import PREFIX, blocks_for, hash_block, schema_with, text_bytes, without

LENGTH = 13
CHUNK_BYTES = 4 << 20
BUCKET_WINDOWS = 2 << 20
_BYTES_PER_WORD = 6
_RUN_BYTES = 1 << 18
_LOW = np.uint64((1 << 40) - 1)
_CHUNK, _BUCKET = f"{PREFIX}chunk", f"{PREFIX}bucket"
_BLOBS = pa.schema([(_BUCKET, pa.int32()), (_CHUNK, pa.int32()), ("entries", pa.binary())])
_BITS = pa.schema([(_CHUNK, pa.int32()), (_BUCKET, pa.int32()), ("bits", pa.binary())])


def _pack(keys: np.ndarray) -> bytes:
    """Sorted distinct integers below 2**40 as differences of 4 bytes, or plainly
    where one needs more."""
    steps = np.diff(keys, prepend=np.uint64(0))
    if len(steps) and steps.max() >> np.uint64(32):
        return b"\x01" + keys.tobytes()
    return b"\x00" + steps.astype(np.uint32).tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    if blob[0]:
        return np.frombuffer(blob, dtype=np.uint64, offset=1)
    return np.cumsum(np.frombuffer(blob, dtype=np.uint32, offset=1), dtype=np.uint64)


class _Chunk:
    """The documents of one chunk in order of their ids, with their windows."""

    def __init__(self, table: pa.Table, length: int, buckets: int, both: bool):
        self.table = table
        self.runs: list[tuple[int, Words]] = []
        at, doc, keys, second = [], [], [], []
        words = 0
        column = table["text"].combine_chunks()
        for row, _, data, offsets in text_runs(column, _RUN_BYTES):
            run = Words(data, offsets)
            starts, hashes = run.windows(length)
            self.runs.append((row, run))
            at.append(starts + words)
            doc.append(row + np.searchsorted(run.first, starts, side="right") - 1)
            bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
            keys.append(bucket << np.uint64(40) | hashes & _LOW)
            if both:
                second.append(run.windows(length, seed=1)[1])
            words += len(run.starts)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.words = words
        self.at, self.doc = join(at, np.int64), join(doc, np.int64)
        self.keys, self.second = join(keys, np.uint64), join(second, np.uint64)
        ids = table["doc_id"].combine_chunks()
        self.known = ~np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        # A document without an id neither removes nor loses anything.
        has_id = self.known[self.doc] if len(self.doc) else np.zeros(0, bool)
        self.at, self.doc, self.keys = self.at[has_id], self.doc[has_id], self.keys[has_id]
        self.second = self.second[has_id] if both else self.second

    def marked(self, answers: pa.Table) -> np.ndarray:
        """Which windows another chunk has, or several documents of this one."""
        distinct, where = np.unique(self.keys, return_inverse=True)
        hit = _answered(distinct, answers)
        if len(distinct):
            least = np.full(len(distinct), np.iinfo(np.int64).max)
            most = np.full(len(distinct), np.iinfo(np.int64).min)
            np.minimum.at(least, where, self.ids[self.doc])
            np.maximum.at(most, where, self.ids[self.doc])
            hit |= least < most
        return hit[where]

    def candidates(self, answers: pa.Table):
        """Windows that are marked; their distinct 104-bit keys, for each window
        the number of its key, and for each key the smallest document id."""
        chosen = np.flatnonzero(self.marked(answers))
        keys, second, ids = self.keys[chosen], self.second[chosen], self.ids[self.doc[chosen]]
        order = np.lexsort((ids, second, keys))
        keys, second, ids = keys[order], second[order], ids[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return chosen, keys[new], second[new], ids[new], number


def _answered(keys: np.ndarray, answers: pa.Table) -> np.ndarray:
    """The bits that the buckets sent for the sorted keys of a chunk."""
    hit = np.zeros(len(keys), dtype=bool)
    edges = keys >> np.uint64(40)
    for bucket, bits in zip(answers[_BUCKET].to_pylist(), answers["bits"].to_pylist()):
        first, end = np.searchsorted(edges, [np.uint64(bucket), np.uint64(bucket + 1)])
        hit[first:end] = np.unpackbits(np.frombuffer(bits, np.uint8), count=end - first).astype(bool)
    return hit


def _by_bucket(keys: np.ndarray):
    buckets = (keys >> np.uint64(40)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(keys) else []
    for a, b in zip(first, [*first[1:], len(keys)]):
        yield int(buckets[a]), a, b


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), (f"{PREFIX}tie", "ascending")])


def _count_entries(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table[_CHUNK][0].as_py()
        keys = np.unique(_Chunk(_ordered(table), length, buckets, False).keys)
        rows = [(b, chunk, _pack(keys[i:j] & _LOW)) for b, i, j in _by_bucket(keys)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, _BLOBS.types)], schema=_BLOBS)

    return run


def _answers(table: pa.Table, hits: list[np.ndarray]) -> pa.Table:
    rows = [
        (c, b, np.packbits(hit).tobytes())
        for c, b, hit in zip(table[_CHUNK].to_pylist(), table[_BUCKET].to_pylist(), hits)
        if hit.any()
    ]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, _BITS.types)], schema=_BITS)


def _shared(table: pa.Table) -> pa.Table:
    """Which entries of each chunk another chunk has too."""
    parts = [_unpack(x) for x in table["entries"].to_pylist()]
    _, where, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    many = (counts > 1)[where]
    return _answers(table, np.split(many, np.cumsum([len(p) for p in parts])[:-1]))


def _candidate_entries(length: int, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = docs[_CHUNK][0].as_py()
        part = _Chunk(_ordered(docs), length, buckets, True)
        _, keys, second, ids, _ = part.candidates(answers)
        rows = []
        for b, i, j in _by_bucket(keys):
            least = int(ids[i:j].min())
            wide = int(ids[i:j].max()) - least >= 1 << 32
            body = (ids[i:j] - least).astype(np.int64 if wide else np.uint32)
            head = np.array([j - i, least, wide], dtype=np.int64).tobytes()
            low = (keys[i:j] & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            rows.append((b, chunk, head + body.tobytes() + low.tobytes() + second[i:j].tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, _BLOBS.types)], schema=_BLOBS)

    return run


def _read_candidates(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, least, wide = np.frombuffer(blob, np.int64, 3)
    at = 24
    ids = np.frombuffer(blob, np.int64 if wide else np.uint32, n, at).astype(np.int64) + least
    at += n * (8 if wide else 4)
    low = np.zeros((n, 8), np.uint8)
    low[:, :5] = np.frombuffer(blob, np.uint8, n * 5, at).reshape(-1, 5)
    return low.view("<u8").ravel(), np.frombuffer(blob, np.uint8, n * 8, at + n * 5).view("<u8"), ids


def _smaller_elsewhere(table: pa.Table) -> pa.Table:
    """Which entries of each chunk another chunk has in a smaller document."""
    parts = [_read_candidates(x) for x in table["entries"].to_pylist()]
    low, second, ids = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((ids, second, low))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (second[order][1:] != second[order][:-1])
    least = np.empty(len(order), dtype=np.int64)
    least[order] = ids[order][new][np.cumsum(new) - 1]
    return _answers(table, np.split(least < ids, np.cumsum([len(p[0]) for p in parts])[:-1]))


def _remove(length: int, buckets: int, schema: pa.Schema):
    def run(docs: pa.Table, shared: pa.Table, smaller: pa.Table) -> pa.Table:
        docs = _ordered(docs)
        part = _Chunk(docs, length, buckets, True)
        chosen, keys, _, ids, number = part.candidates(shared)
        elsewhere = _answered(keys, smaller)[number]
        gone = chosen[elsewhere | (ids[number] < part.ids[part.doc[chosen]])]
        cover = np.zeros(part.words + 1, dtype=np.int64)
        np.add.at(cover, part.at[gone], 1)
        np.add.at(cover, part.at[gone] + length, -1)
        covered = np.cumsum(cover[:-1]) > 0
        counts, removed, spans, texts, base = [], [], [], [], 0
        for _, run_ in part.runs:
            body = run_.data.tobytes()
            for a, b in zip(run_.first[:-1], run_.first[1:]):
                mask = covered[base + a : base + b]
                counts.append(int(b - a))
                removed.append(int(mask.sum()))
                if not removed[-1]:
                    spans.append([])
                    texts.append(None)
                    continue
                edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
                spans.append([{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)])
                left = a + np.flatnonzero(~mask)
                texts.append(b" ".join([body[s:e] for s, e in zip(run_.starts[left].tolist(), run_.ends[left].tolist())]).decode())
            base += len(run_.starts)
        own = {"n_words": counts, "n_removed": removed, "spans": spans, "left_text": texts}
        return pa.table([pa.array(own[f.name], f.type) if f.name in own else docs[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Adds to each row of `docs` (with `doc_id` and `text`): `n_words`,
    `n_removed`, `spans` (array of maximal word intervals [start, end) that go)
    and `left_text`, the words that stay joined by a space; NULL where none goes.

    A word goes if a window of `length` words over it also starts in a document
    with a smaller `doc_id`. A NULL text has no words; rows without `doc_id` keep
    theirs and remove nothing; rows that share a `doc_id` remove nothing from each
    other. An empty table gives an empty result. Other columns pass through.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = without(docs, ("n_words", "n_removed", "spans", "left_text"))
    total = text_bytes(docs)
    buckets = blocks_for(total // _BYTES_PER_WORD, bucket_windows)
    held = docs.withColumn(_CHUNK, hash_block(blocks_for(total, chunk_bytes), "doc_id")).withColumn(
        f"{PREFIX}tie", F.xxhash64("text")
    )
    by_chunk = held.groupBy(_CHUNK)
    entries = by_chunk.applyInArrow(tidy_group(_count_entries(length, buckets)), f"{_BUCKET} int, {_CHUNK} int, entries binary")
    bits = f"{_CHUNK} int, {_BUCKET} int, bits binary"
    shared = entries.groupBy(_BUCKET).applyInArrow(tidy_group(_shared), bits)
    candidates = by_chunk.cogroup(shared.groupBy(_CHUNK)).applyInArrow(
        tidy_group(_candidate_entries(length, buckets)), f"{_BUCKET} int, {_CHUNK} int, entries binary"
    )
    smaller = candidates.groupBy(_BUCKET).applyInArrow(tidy_group(_smaller_elsewhere), bits)
    answers = shared.withColumn("round", F.lit(1)).unionByName(smaller.withColumn("round", F.lit(2)))
    out = schema_with(docs, "n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, left_text string")
    remove = _remove(length, buckets, to_arrow_schema(out))

    def last(docs_: pa.Table, answers_: pa.Table) -> pa.Table:
        rounds = np.asarray(answers_["round"])
        return remove(docs_, answers_.filter(pa.array(rounds == 1)), answers_.filter(pa.array(rounds == 2)))

    return by_chunk.cogroup(answers.groupBy(_CHUNK)).applyInArrow(tidy_group(last), out)
