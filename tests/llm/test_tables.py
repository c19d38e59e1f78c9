"""Mixing, resharding and top-k, the queries with SQL, and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import mixing, queries, sharding, topk
from millrace.llm.oracles import ORACLES
from millrace.sources.scratch import scratch_path
from tests.compare import duck_rows, spark_rows
from tests.llm import brute
from tests.llm.test_texts import ODD, SCHEMA


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == duck_rows(con, ORACLES[name])


def leaf_rows(spark, leaves):
    rows, next_id = [], itertools.count()
    for (domain, lang, source), sizes in leaves.items():
        rows += [(next(next_id), "w " * n, lang, source, domain) for n in sizes]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kind string")


def taken(df):
    return {tuple(r[:3]): r[3] for r in df.groupBy("domain", "lang", "source").agg(F.sum("taken")).collect()}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    docs = leaf_rows(spark, {("a", "en", "s1"): [10], ("a", "en", "s2"): [100] * 10, ("a", "de", "s3"): [100] * 10, ("b", "en", "s4"): [100] * 10})
    used = taken(mixing.select_documents(docs, F.col("kind"), {}, budget=800, epochs=1))
    # 400 for each domain, 200 for each language of a; s1 has only 10, s2 takes the 90.
    assert used == {("a", "en", "s1"): 10, ("a", "en", "s2"): 190, ("a", "de", "s3"): 200, ("b", "en", "s4"): 400}
    docs = leaf_rows(spark, {("a", "en", "s1"): [10], ("a", "de", "s3"): [50], ("b", "en", "s4"): [100] * 10})
    used = taken(mixing.select_documents(docs, F.col("kind"), {}, budget=800, epochs=2))
    assert used == {("a", "en", "s1"): 20, ("a", "de", "s3"): 100, ("b", "en", "s4"): 680}


def test_prefix_of_seeded_epochs(spark):
    docs = leaf_rows(spark, {("a", "en", "s"): [7] * 30})
    one = mixing.select_documents(docs, F.col("kind"), {}, budget=520, epochs=3).collect()
    assert sum(r.taken for r in one) == 520
    assert sorted(r.doc_id for r in one if r.epoch == 0) == sorted(r.doc_id for r in one if r.epoch == 1) == list(range(30))
    assert sorted(r.taken for r in one if r.epoch == 2) == [2, *[7] * 14]
    other = mixing.select_documents(docs, F.col("kind"), {}, budget=520, epochs=3, seed=18).collect()
    assert {r.doc_id for r in other if r.epoch == 2} != {r.doc_id for r in one if r.epoch == 2}


def test_mixing_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({"epoch": F.lit("x"), "tokens": F.lit(1)})
    rows = mixing.select_documents(odd, queries.source_domain(), queries.MIX_WEIGHTS).collect()
    total = sum(len(brute.words(t)) for _, t, _, _ in ODD)
    assert sum(r.taken for r in rows) == total
    assert all(0 <= r.taken <= r.tokens for r in rows)
    mixed = mixing.mix(odd, queries.source_domain(), queries.MIX_WEIGHTS)
    assert mixed.dtypes[-2:] == [("epoch", "int"), ("taken", "bigint")] and mixed.count()
    assert mixing.select_documents(odd.limit(0), F.lit("a"), {}).collect() == []


def test_mix_cuts_texts_and_loses_no_row(spark):
    rows = [(1, "a  b\tc\nd e", 5), (None, " f g h i", 6), (None, None, 7), (2, "j k l m n", 8), (2, "o p q r s t", 9)]
    docs = spark.createDataFrame([(d, t, "en", "s", n) for d, t, n in rows], "doc_id bigint, text string, lang string, source string, tokens int")
    for budget in (1, 7, 18, 20, 29, 48):
        found = mixing.mix(docs, F.lit("d"), {}, budget=budget).collect()
        assert sum(len(brute.words(r.text)) for r in found) == sum(r.taken for r in found) == budget
        texts = {n: t for _, t, n in rows}
        for r in found:
            whole = texts[r.tokens]
            assert (whole or "").startswith(r.text or "") and r.cut == (r.text != whole)
            assert len(brute.words(r.text)) == r.taken
    assert sorted(r.tokens for r in found if r.epoch == 0) == [5, 6, 7, 8, 9]  # rows without id and repeated ids
    assert mixing.mix(docs.limit(0), F.lit("d"), {}).collect() == []


def least_moved(supplies, capacities):
    return sum(max(0, s - c) for s, c in zip(supplies, capacities))


def test_min_cost_flow():
    rng = random.Random(7)
    for _ in range(50):
        n = rng.randrange(1, 7)
        supplies = [rng.randrange(100) for _ in range(n)]
        capacities = sharding.equal_capacities(sum(supplies), n)
        flow = sharding.min_cost_flow(supplies, capacities)
        assert [sum(f) for f in flow] == supplies and [sum(c) for c in zip(*flow)] == capacities
        assert sum(flow[i][j] for i in range(n) for j in range(n) if i != j) == least_moved(supplies, capacities)
    # With given costs: against all ways of a small instance.
    costs = [[4, 1, 7], [2, 9, 3], [5, 5, 1]]
    flow = sharding.min_cost_flow([1, 1, 1], [1, 1, 1], costs)
    best = min(sum(costs[i][p[i]] for i in range(3)) for p in itertools.permutations(range(3)))
    assert sum(costs[i][j] * flow[i][j] for i in range(3) for j in range(3)) == best
    with pytest.raises(ValueError):
        sharding.min_cost_flow([1], [2])


def test_resharding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("shard", F.lit("mine"))
    before = F.when(F.col("source") < "src15", 0).otherwise(1)
    old = sharding.write_shards(docs, before, 4, scratch_path(spark, "old"))
    new = sharding.reshard_bytes(spark, old, 4, scratch_path(spark, "new"))
    rows = new.read(spark).withColumn("size", sharding.text_size()).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in docs.collect())
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes)
    was = {r.doc_id: r.shard for r in old.read(spark).collect()}
    moved = sum(r["size"] for r in rows if was[r.doc_id] != r.shard)
    old_sizes = [sum(r["size"] for r in rows if was[r.doc_id] == s) for s in range(4)]
    assert moved <= 1.01 * least_moved(old_sizes, sharding.equal_capacities(sum(old_sizes), 4)) + 1000


def test_untouched_shards_keep_their_files(spark):
    rows = [(i, "x" * 99, i % 4) for i in range(400)] + [(1000 + i, "x" * 99, 0) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, s int")
    old = sharding.write_shards(docs.where("doc_id < 1000"), F.col("s"), 4, scratch_path(spark, "old"))
    assert sharding.reshard_bytes(spark, old, 4, scratch_path(spark, "new")) == old


def test_slots_of_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    old = sharding.write_shards(odd, F.lit(2), 16, scratch_path(spark, "old"))
    new = sharding.reshard_bytes(spark, old, 16, scratch_path(spark, "new")).read(spark)
    rows = sharding.with_slots(new.select("doc_id", sharding.text_size().alias("size"), "shard"), slot_rows=2).collect()
    assert len(rows) == len(ODD)
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def top_k_by_sorting(rows, is_query, k):
    out = []
    for q, w in rows:
        if is_query(q):
            scores = sorted((-int(np.dot(w, v)), i) for i, v in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("scale", [3, 10**6])
def test_top_k(spark, scale):
    rng = np.random.default_rng(8)
    weights = rng.integers(-scale, scale + 1, size=(120, 6)) * (rng.random((120, 6)) < 0.5)
    rows = [(i, [int(x) for x in w]) for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "vec_id bigint, weights array<bigint>").repartition(5)
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, k=7, block_rows=16).collect()
    assert sorted(map(tuple, found)) == top_k_by_sorting([(i, np.array(w)) for i, w in rows], lambda q: q % 10 == 0, 7)
    few = topk.top_k(df.where("vec_id < 4"), F.col("vec_id") == 0, k=7).collect()
    assert len(few) == 3
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, [float("nan"), 1.0]), (40, None), (3, [float("inf"), 0.0]), (4, [None, 1.0]), (5, []), (None, [1.0, 1.0]), (6, [-0.01, 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("weights", F.lit(1))
    assert sorted((r.vec_id, r.weights) for r in topk.usable_vectors(df).collect()) == [(0, [64, 128]), (6, [-1, 32])]


def test_stages_of_the_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "encoding":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert {r.doc_id for r in after} <= {d for d, _ in before}
        if name == "near_duplicates":
            want = {d for (d, _), (_, c) in zip(before, brute.components(before, 5, 80)) if d == c}
            assert {r.doc_id for r in after} == want
        if name == "substrings":
            texts = {}
            for (d, t), (own, mask) in zip(before, brute.removals(before)):
                if not own or not all(mask):
                    texts[d] = " ".join(w for w, m in zip(own, mask) if not m) if any(mask) else t
            assert {r.doc_id: r.text for r in after} == texts
        if name == "mixing":
            total = sum(len(brute.words(t)) for _, t in before)
            assert sum(len(brute.words(r.text)) for r in after) == total
        if name == "encoding":
            assert len(after) == len(before) and all(r.n_tokens == len(r.ids) // 4 for r in after)


def test_pipeline_on_odd_rows(spark, sf_dir, tmp_path):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumn("n_chars", F.length("text").cast("bigint"))
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, name)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


@pytest.mark.parametrize("scale, kind", [(60, np.float32), (10**6, np.float64), (10**8, np.int64)])
def test_scores_of_groups_of_terms_are_exact(scale, kind):
    rng = np.random.default_rng(9)
    terms = 2 * topk.TERMS + 3
    queries, block = (rng.integers(-scale, scale + 1, size=(n, terms)) * (rng.random((n, terms)) < 0.1) for n in (9, 40))
    queries[0], block[0] = scale, scale
    queries[3], block[:, : topk.TERMS] = 0, 0
    scores = topk._accumulate(queries, block)
    assert scores.dtype == kind and (scores.astype(np.int64) == queries @ block.T).all()
