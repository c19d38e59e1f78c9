"""Every query against its SQL; the rest by row count and invariants."""

import pytest

import __spark_entry__ as driver
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES
from tests.compare import difference


@pytest.mark.parametrize("name", [q for q in QUERIES if q in ORACLES])
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, name) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    row = driver.entry(spark).first()
    assert (row.start, row.target, row.degree, row.directions) == (0, 14, 6, 3)


def rows(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def test_sample_random(spark, sf_dir):
    sample = rows(spark, sf_dir, "sample_random")
    assert len(sample) == 51 and len({r.c_custkey for r in sample}) == 51


def test_random_split_covers_the_input_once(spark, sf_dir):
    parts = rows(spark, sf_dir, "random_split")
    assert sorted(r.o_orderkey for r in parts) == list(range(1500))
    assert 0.6 < sum(r.part == "train" for r in parts) / 1500 < 0.8


def test_kmeans_queries(spark, sf_dir):
    points = rows(spark, sf_dir, "kmeans_fit")
    assert {r.k for r in points} == {51} and points[0].num_features == 4
    assert sum(r.size for r in points) == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    summary = rows(spark, sf_dir, "kmeans_summary")
    assert summary[0].distance_measure == "euclidean" and summary[0].num_features == 64
    assert summary[0].iterations <= 30
    sizes = {r.cluster: r.size for r in summary}
    predicted = rows(spark, sf_dir, "kmeans_predict")
    assert len(predicted) == 500
    counts = {}
    for r in predicted:
        counts[r.cluster] = counts.get(r.cluster, 0) + 1
    assert counts == {k: n for k, n in sizes.items() if n}
    assert len(rows(spark, sf_dir, "kmeans_centers")) == 10 * 64
    assert -1 <= rows(spark, sf_dir, "kmeans_silhouette")[0].silhouette <= 1


def test_linear_queries(spark, sf_dir):
    tuned = rows(spark, sf_dir, "linear_tune")
    assert sorted(r.reg_param for r in tuned) == [0.1, 100.0, 10000.0]
    best = [r for r in tuned if r.is_best]
    assert len(best) == 1 and best[0].metric == min(r.metric for r in tuned)
    terms = rows(spark, sf_dir, "linear_best_model")
    assert [r.term for r in terms] == ["l_quantity", "l_discount", "l_tax", "(intercept)"]
    assert {r.reg_param for r in terms} == {best[0].reg_param}
    weights = {r.term: r.coefficient for r in terms}
    for r in rows(spark, sf_dir, "linear_score")[:50]:
        by_hand = weights["(intercept)"] + sum(
            weights[t] * v for t, v in zip(["l_quantity", "l_discount", "l_tax"], [r.f0, r.f1, r.f2])
        )
        assert r.prediction == pytest.approx(by_hand)


def test_logistic_queries(spark, sf_dir):
    report = rows(spark, sf_dir, "logistic_fit")
    assert {(r["class"], r.position) for r in report} == {(c, p) for c in (0, 1) for p in range(-1, 10)}
    for name in ("logistic_score", "logistic_quality"):
        scored = rows(spark, sf_dir, name)
        assert scored
        assert all((r.prediction == 1.0) == (r.probability > 0.5) for r in scored)
