"""Toxic texts by a linear classifier on character n-grams.

Hashed n-grams of 3 to 5 characters, by their rate in the text, scaled by their
naive Bayes log-count ratio, in a logistic regression. It is fitted on a bounded sample
of labelled rows (`SAMPLE`, those first in the order of a hash of their id); all
texts are scored whole. The model is a weight per hash bucket, 1 MB.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import mix, tidy
from millrace.llm.components import _stored
from millrace.llm.frames import schema_with, without

ORDERS = (3, 4, 5)
BITS = 18
SAMPLE = 20_000
FEATURES = 1 << 13
MIN_TEXTS = 3
PER = 2000
_PIECE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased texts as code points, with their text numbers and whether an n-gram
    may begin there, at most about `_PIECE` at once. A longer text comes in pieces
    that overlap by what an n-gram begun inside one may need of the next."""
    parts, numbers, held = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(len(text), 1), _PIECE):
            piece = text[at : at + _PIECE + max(ORDERS) - 1]
            parts.append(piece)
            numbers.append((i, len(piece)))
            held += len(piece)
            if held >= _PIECE:
                yield _codes(parts), *_numbers(numbers)
                parts, numbers, held = [], [], 0
    if parts:
        yield _codes(parts), *_numbers(numbers)


def _codes(parts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)


def _numbers(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [n for _, n in pairs]
    begins = np.concatenate([np.arange(n) < _PIECE for n in sizes])
    return np.repeat(np.array([i for i, _ in pairs]), sizes), begins


def present(texts: list[str | None], useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, count) of the n-grams; of useful buckets only, if given."""
    found, counts = [], []
    for codes, text, begins in _pieces(texts):
        value = codes.copy()
        for order in range(2, max(ORDERS) + 1):
            value = value[: len(codes) - order + 1] * _BASE + codes[order - 1 :]
            if order not in ORDERS or not len(value):
                continue
            bucket = (mix(value + np.uint64(order)) >> np.uint64(64 - BITS)).astype(np.int64)
            keep = begins[: len(value)] & (text[: len(value)] == text[order - 1 :])
            if useful is not None:
                keep &= useful[bucket]
            pairs, times = np.unique(text[: len(value)][keep] << BITS | bucket[keep], return_counts=True)
            found.append(pairs)
            counts.append(times)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs, where = np.unique(np.concatenate(found), return_inverse=True)
    return pairs >> BITS, pairs & ((1 << BITS) - 1), np.bincount(where, np.concatenate(counts), len(pairs)).astype(np.int64)


def values(texts: list[str | None], text: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How much of a text is an n-gram: the logarithm of 1 + its count in about
    `PER` characters. Long texts hold every n-gram now and then."""
    chars = np.array([len(t or "") for t in texts])
    return np.log1p(PER * counts / (chars[text] + PER / 4))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        toxic = np.asarray(batch["toxic"]).astype(np.int64)
        for i in range(0, batch.num_rows, 500):
            text, bucket, _ = present(batch["text"].slice(i, 500).to_pylist())
            label = toxic[i : i + 500][text]
            for c in (0, 1):
                total[c] += np.bincount(bucket[label == c], minlength=1 << BITS)
    used = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])], ["bucket", "clean", "toxic"]
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Learn `labels` (doc_id, toxic 0/1) on the texts of `docs` (doc_id, text).

    At most `sample` labelled documents are used. NULL labels are left out; a
    document labelled twice counts as toxic if one label says so; NULL texts count
    as empty. With no labels, or of one class only, the model is a constant: the
    share of toxic rows with one of each class added.
    """
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = _stored(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic")),
        "labelled",
    )
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    weights = np.zeros(1 << BITS)
    if not (n_clean and n_toxic):
        return Model(weights.astype(np.float32), float(np.log((n_toxic + 1) / (n_clean + 1))))

    counts = (
        rows.select("text", "toxic")
        .mapInArrow(tidy(_counts), "bucket bigint, clean bigint, toxic bigint")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= MIN_TEXTS)
        .toPandas()  # at most 2**BITS rows
        .sort_values("bucket")
    )
    p, q = (counts["toxic"] + 1) / (n_toxic + 2), (counts["clean"] + 1) / (n_clean + 2)
    ratio = np.log(p / q).to_numpy()
    # The ratio in its standard errors decides which features are worth a weight.
    error = np.sqrt(1 / (counts["toxic"] + 1) + 1 / (counts["clean"] + 1)).to_numpy()
    best = np.sort(np.argsort(-np.abs(ratio) / error, kind="stable")[:features])
    buckets, ratio = counts["bucket"].to_numpy()[best], ratio[best]
    useful = np.zeros(1 << BITS, dtype=bool)
    useful[buckets] = True

    def chosen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                texts = part["text"].to_pylist()
                text, bucket, count = present(texts, useful)
                cuts = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                column = np.searchsorted(buckets, bucket)
                scaled = values(texts, text, count) * ratio[column]
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (column, scaled)]
                yield pa.RecordBatch.from_arrays([part["toxic"].cast(pa.float64()), *lists], ["label", "at", "scaled"])

    size = len(buckets)
    vector = F.udf(lambda at, scaled: Vectors.sparse(size, at, scaled), VectorUDT())  # on `sample` rows
    train = rows.select("text", "toxic").mapInArrow(tidy(chosen_features), "label double, at array<bigint>, scaled array<double>")
    train = train.select("label", vector("at", "scaled").alias("features")).persist()
    try:
        model = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False).fit(train)
    finally:
        train.unpersist()
    weights[buckets] = model.coefficients.toArray() * ratio
    return Model(weights.astype(np.float32), float(model.intercept))


def score(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `score` (0 to 1) to every row, from the whole text; a NULL or empty text
    scores as one without features. Columns named `score` are replaced; `keep`
    names the columns to return beside it, by default all."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = without(docs, ("score",))
    kept = docs.columns if keep is None else list(keep)
    out = schema_with(docs.select(*[F.col(f"`{c}`") for c in kept]), "score double")
    schema = to_arrow_schema(out)
    weights, intercept = model.weights, model.intercept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        useful = weights != 0
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                texts = part["text"].to_pylist()
                text, bucket, count = present(texts, useful)
                sums = np.bincount(text, weights[bucket] * values(texts, text, count), minlength=part.num_rows) + intercept
                scores = pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))))
                yield pa.RecordBatch.from_arrays([*[part[f.name].cast(f.type) for f in list(schema)[:-1]], scores], schema=schema)

    return docs.mapInArrow(tidy(run), out)


def held_out(doc_id: str = "doc_id"):
    """Whether a row belongs to the fifth of documents that no label is learnt from;
    false for rows without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_and_score(docs: DataFrame, labels: DataFrame, keep: Sequence[str] | None = None, **options) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted`; labels of held-out documents
    are not read."""
    model = fit(docs, labels.where(~held_out()), **options)
    docs = without(docs, ("held_out", "predicted"))
    return score(docs, model, keep).withColumns(
        {"held_out": held_out(), "predicted": (F.col("score") >= 0.5).cast("int")}
    )
