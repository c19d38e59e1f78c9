"""The count-vector tree join against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import count_tree, queries
from tests.llm import brute
from tests.llm.test_texts import ODD, SCHEMA


def check(df, shingle, percent, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = count_tree.jaccard_join(df, shingle, percent, **options).collect()
    sizes = [len(brute.shingles(t, shingle)) for _, t in rows]
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == sorted((str(d), n) for (d, _), n in zip(rows, sizes))
    want = {d: c for (d, _), (_, c) in zip(rows, brute.components(rows, shingle, percent))}
    assert {r.doc_id: r.component_id for r in found} == want


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def families(seed=5, many=60):
    """Originals of many lengths with copies around the threshold, and one family
    whose copies are linked with the original alone."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 3, 8, 12, 19, 20, 21, 40, 90, 200, 700):
        for _ in range(3):
            base = [f"v{rng.randrange(3000)}" for _ in range(size)]
            rows += [" ".join(base)] + [edited(rng, base, e) for e in (0, 1, 1, 2, 3, 3) if e < size]
            rows += [" ".join(base[: max(1, size * 19 // 20)]), " ".join(base + base[: size // 20])]
    base = [f"star{i}" for i in range(110)]
    rows += [edited(rng, base, 1) for _ in range(many)] + [" ".join(base)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"leaf": 3}])
def test_join_is_exact(spark, options):
    df = spark.createDataFrame(families(), "doc_id bigint, text string").withColumns({"key": F.lit("x"), "n": F.lit(1), "point": F.lit(2)})
    check(df.repartition(5), 3, 90, **options)


def test_trees_alone_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(count_tree, "HUB_ROUNDS", 0)
    df = spark.createDataFrame(families(9, 25), "doc_id bigint, text string")
    check(df.repartition(5), 3, 80, leaf=7)


def test_odd_rows(spark):
    odd = [(d, t) for d, t, _, _ in ODD]
    texts = [(50, "a b c d e f g h"), (50, "p q r s t u v w"), (51, "P q r s t u v w"), (40, "a b c d e f g h"), (None, "a b c d e f g h")]
    df = spark.createDataFrame(odd + texts, "doc_id bigint, text string")
    found = {}
    for r in count_tree.jaccard_join(df, 3, 90).collect():
        found.setdefault(r.doc_id, set()).add(r.component_id)
    assert found[50] == found[51] == found[40] == {40} and found[None] == {None}
    assert found[1] == {1} and found[2] == {2} and found[8] == found[7] == {7} and found[6] == found[3] == {3}
    assert count_tree.jaccard_join(df.limit(0), 3, 90).collect() == []


def test_large_classes_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(count_tree, "CLASS_ROWS", 5)
    rows = [(i, "same text in very many documents of this table") for i in range(100)] + [(100 + i, f"other {i}") for i in range(20)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90)


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)
    found = queries.QUERIES["op12_jaccard_join"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_shingles", "component_id"] and found.count() == 200


def test_tree_join_keeps_all_that_the_bound_allows():
    rng = np.random.default_rng(2)
    points = rng.poisson(rng.choice([1, 2, 6], size=(150, 1)), size=(150, count_tree.GROUPS)).astype(np.int64)
    points[75:] = np.maximum(points[:75] + rng.integers(-1, 2, size=(75, count_tree.GROUPS)) * (rng.random((75, count_tree.GROUPS)) < 0.1), 0)
    sizes = points.sum(axis=1)
    order = np.argsort(sizes, kind="stable")
    points, sizes = points[order], sizes[order]
    names = np.arange(150) // 2
    tree = count_tree._Tree(points, sizes, names, 1)
    a, b = count_tree.tree_join(tree, tree, 90)
    shared = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = (190 * shared >= 90 * (sizes[:, None] + sizes[None])) & (names[:, None] != names[None])
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(list, map(np.ndarray.tolist, np.nonzero(want)))))
    assert want.any()


def test_size_classes():
    for percent in (50, 80, 90, 97):
        bounds = count_tree.size_bounds(percent, 3000)
        of = lambda n: np.searchsorted(bounds, n, side="right") - 1
        for n in range(1, 1500):
            assert 0 <= of(100 * n // percent) - of(n) <= 1
        assert (np.diff(bounds) > 0).all()


def test_packed_points_bound_the_overlap():
    """Also of documents with counts beyond a byte."""
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, size=(6, count_tree.FINE_GROUPS))
    counts[3:, :40] += rng.integers(0, 900, size=(3, 40))
    doc = np.repeat(np.arange(6), counts.sum(axis=1))
    group = np.concatenate([np.repeat(np.arange(count_tree.FINE_GROUPS), row) for row in counts])
    fine, excess, coarse = count_tree._unpacked(count_tree._packed(doc, group, 6))
    assert (fine.sum(axis=1, dtype=np.int64) + excess == counts.sum(axis=1)).all()
    for a in range(6):
        for b in range(6):
            shared = np.minimum(counts[a], counts[b]).sum()
            bound = np.minimum(fine[a], fine[b]).sum(dtype=np.int64) + min(excess[a], excess[b])
            assert shared <= bound <= np.minimum(coarse[a], coarse[b]).sum()
