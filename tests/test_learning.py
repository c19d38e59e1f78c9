import hashlib
import math
import random
import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import classification, evaluation, features, ranks, regression, relational
from millrace.operators.ordering import running_totals


def pairs(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "prediction double, label double")


def roc_by_hand(rows):
    pos = sum(y > 0.5 for _, y in rows)
    neg = len(rows) - pos
    points = [(0.0, 0.0)]
    for cut in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(s >= cut and y > 0.5 for s, y in rows)
        fp = sum(s >= cut and y <= 0.5 for s, y in rows)
        points.append((fp / neg if neg else 0.0, tp / pos if pos else 0.0))
    return [*points, (1.0, 1.0)]


def curve(df, **names):
    return [(r.fpr, r.tpr) for r in evaluation.roc_curve(df, **names).orderBy("position").collect()]


SCORES = [(1, 1), (1, 0), (0, 0), (0, 1)]


def test_hard_predictions(spark):
    df = pairs(spark, SCORES)
    assert evaluation.accuracy(df).first().accuracy == 0.5
    assert curve(df) == [(0, 0), (0.5, 0.5), (1, 1), (1, 1)]
    assert sorted(tuple(r) for r in evaluation.confusion_matrix(df).collect()) == [
        (0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1),
    ]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_roc_over_many_ranges(spark, coalesce):
    """Without coalescing every range is its own task."""
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), float(rng.random() < 0.4)) for _ in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = curve(pairs(spark, rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(a == pytest.approx(b) for a, b in zip(got, roc_by_hand(rows), strict=True))
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(got, got[1:]))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(got, got[1:]))
    library = BinaryClassificationEvaluator(rawPredictionCol="prediction", numBins=0)
    assert area == pytest.approx(library.evaluate(pairs(spark, rows)))


@pytest.mark.parametrize("label", [0, 1])
def test_roc_with_one_class(spark, label):
    rows = [(0.2, label), (0.8, label)]
    assert curve(pairs(spark, rows)) == roc_by_hand(rows)


def test_regression_metrics_equal_the_library(spark):
    rng = random.Random(2)
    df = pairs(spark, [(rng.gauss(0, 3), rng.gauss(1, 2)) for _ in range(100)])
    got = evaluation.regression_metrics(df).first()
    for name in ("rmse", "mse", "mae", "r2"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))


def test_indexing_and_encoding(spark):
    df = spark.createDataFrame([(c,) for c in "bbaac"], "c string")
    encoded = features.one_hot(df, ["c"]).select("c", "c_index", vector_to_array("c_vector").alias("v"))
    got = {r.c: (r.c_index, r.v) for r in encoded.collect()}
    assert got == {"a": (0, [1, 0]), "b": (1, [0, 1]), "c": (2, [0, 0])}


def test_unseen_category_and_missing_value_are_errors(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    other = spark.createDataFrame([("z",)], "c string")
    model = features.rank_indexer(["c"]).fit(train)
    with pytest.raises(Exception, match="no rank in column c: z"):
        model.transform(other).collect()
    missing = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        features.assemble(missing, ["a", "b"]).collect()
    kept = features.assemble(missing, ["a", "b"], handle_invalid="keep")
    assert math.isnan(kept.select(vector_to_array("features").alias("v")).first().v[1])


def test_columns_with_spaces(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "Price double, `Area Income` double, `No.` double")
    rows = relational.with_label(df, "Price", ["Area Income"])
    assert rows.columns == ["label", "Area Income"]
    assert relational.project(df, ["No."]).first()[0] == 3.0
    assert features.assemble(rows, ["Area Income"]).count() == 1


def test_linear_recovers_a_plane(spark):
    rng = random.Random(1)
    rows = [(3 * a - 2 * b + 7 + rng.gauss(0, 0.01), a, b) for a, b in
            ((rng.random() * 10, rng.random() * 10) for _ in range(300))]
    df = features.assemble(spark.createDataFrame(rows, "label double, a double, b double"), ["a", "b"])
    model = regression.tune_linear(df, reg_params=(100.0, 1.0, 0.0))
    report = regression.tuning_report(spark, model).collect()
    assert [r.reg_param for r in report if r.is_best] == [0.0]
    terms = {r.term: r.coefficient for r in regression.linear_report(spark, model.model, ["a", "b"]).collect()}
    assert terms["a"] == pytest.approx(3, abs=0.01) and terms["b"] == pytest.approx(-2, abs=0.01)
    assert terms["(intercept)"] == pytest.approx(7, abs=0.05)


def separable(spark):
    rows = [(i, float(x > 0), float(x), "up" if x > 0 else "down")
            for i, x in enumerate([*range(-20, 0), *range(1, 21)])]
    return spark.createDataFrame(rows, "id int, label double, x double, side string")


def test_light_regularisation_learns_what_the_default_cannot(spark):
    df = separable(spark)
    light = classification.fit_logistic(df, ["side"], ["x", "side"], reg_param=0.001, elastic_net=0.0)
    scored = classification.score_logistic(light, df, ["id", "label"])
    assert evaluation.accuracy(scored).first().accuracy == 1.0
    report = classification.logistic_report(spark, light).collect()
    assert {(r["class"], r.position) for r in report} == {(c, p) for c in (0, 1) for p in (-1, 0, 1)}


def test_hash_split_is_disjoint_and_complete(spark):
    df = spark.range(1000)
    train, test = relational.hash_split(df, "id")
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert a | b == set(range(1000)) and not a & b and len(a) == 671
    again = {r.id for r in relational.hash_split(df.repartition(7), "id")[0].collect()}
    assert again == a


def test_hash_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None,), (1,)], "id bigint")
    train, test = relational.hash_split(df, "id")
    assert [r.id for r in train.unionByName(test).where("id is null").collect()] == [None]


def test_samples_have_the_exact_size(spark):
    df = spark.range(100)
    assert relational.sample_exact(df, 10, 1).count() == 10
    assert relational.sample_exact(df, 1000).count() == 100
    assert relational.sample_by_hash(df, 10, "id").count() == 10
    assert [r.id for r in relational.head_rows(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]


def test_a_callers_cache_survives_a_fit(spark):
    df = separable(spark).cache()
    df.count()
    classification.fit_logistic(df, ["side"], ["x", "side"])
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()


@pytest.mark.parametrize("popular", [3, 1000])
def test_ranks_equal_the_librarys_indexer(spark, monkeypatch, tmp_path, popular):
    monkeypatch.setattr(ranks, "POPULAR", popular)
    rng = random.Random(4)
    rows = [(i, f"k{int(rng.random() ** 2 * 40)}", float(i % 3)) for i in range(400)] + [(i, "hot", 0.0) for i in range(400, 600)]
    df = spark.createDataFrame(rows, "id int, c string, label double")
    want = StringIndexer(inputCol="c", outputCol="i").fit(df).transform(df).select("id", "i").collect()
    got = features.index_categories(df, ["c"])
    assert got.columns == ["id", "c", "label", "c_index"]
    assert {r.id: r.c_index for r in got.collect()} == {r.id: r.i for r in want}
    missing = df.union(spark.createDataFrame([(0, None, 0.0)], "id int, c string, label double"))
    with pytest.raises(Exception, match="no rank in column c: NULL"):
        features.index_categories(missing, ["c"]).collect()
    # In a pipeline, saved and loaded.
    model = features.feature_pipeline(["c"], ["label", "c"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    vectors = [m.transform(df).orderBy("id").select("features").collect() for m in (model, again)]
    assert vectors[0] == vectors[1] and vectors[0][599].features.size == 1 + len({r[1] for r in rows}) - 1


def test_a_million_categories(spark):
    df = spark.range(1_000_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"))
    df = df.union(spark.range(1000).select("id", F.lit("v999999")))
    indexed = features.index_categories(df, ["c"])
    facts = indexed.agg(F.count_distinct("c_index").alias("n"), F.max("c_index").alias("last")).first()
    assert (facts.n, facts["last"]) == (1_000_000, 999_999.0)
    assert indexed.where("c = 'v999999'").select("c_index").distinct().collect() == [(0.0,)]


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 2000])
def test_least_rows_of_any_number(spark, monkeypatch, n):
    """Cut by counts down to two rows, with equal marks and rows without a key."""
    monkeypatch.setattr(relational, "CUT_ROWS", 2)
    df = spark.range(990).withColumn("k", F.when(F.col("id") % 99 != 0, F.col("id"))).repartition(3)
    got = relational.sample_by_hash(df, n, "k").collect()
    marks = sorted(hashlib.md5(("" if i % 99 == 0 else str(i)).encode()).hexdigest() for i in range(990))
    assert len(got) == min(n, 990)
    assert sorted(hashlib.md5(("" if r.k is None else str(r.k)).encode()).hexdigest() for r in got) == marks[:n]


def test_large_samples_are_not_limited_in_one_task(spark):
    df = spark.range(400_000)
    rows = relational.sample_by_hash(df, 200_000, "id")
    assert rows.count() == 200_000
    taken = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", rows._jdf.queryExecution().toString())]
    assert taken and max(taken) < 100


def test_stored_parts_are_stable(spark):
    """Disjoint and covering though the input is shuffled anew, on any number of cores."""
    df = spark.range(3000).withColumn("x", F.rand())
    for key in (None, "id"):
        parts = relational.random_split(df, (0.5, 0.3, 0.2), seed=4, key=key)
        ids = [{r.id for r in p.repartition(k + 2).collect()} for k, p in enumerate(parts)]
        again = [{r.id for r in p.coalesce(1).collect()} for p in parts]
        assert ids == again and sum(map(len, ids)) == 3000 and set().union(*ids) == set(range(3000))
        assert parts[0].columns == ["id", "x"]
    one = {r.id for r in relational.random_split(df.coalesce(1), seed=4, key="id")[0].collect()}
    assert one == {r.id for r in relational.random_split(df.repartition(9), seed=4, key="id")[0].collect()}


def test_tuning_does_not_depend_on_the_layout(spark):
    rng = random.Random(2)
    rows = [(i, 3.0 * (i % 17) + rng.gauss(0, 1), float(i % 17)) for i in range(500)]
    df = features.assemble(spark.createDataFrame(rows, "id int, label double, a double"), ["a"])
    metrics = [regression.tune_linear(d, key="id").metrics for d in (df.coalesce(1), df.repartition(6))]
    assert metrics[0] == pytest.approx(metrics[1])


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    row = evaluation.regression_metrics(df).first()
    assert row.r2 is None and row.mse == 0.5


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_running_totals(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(5)
        got = running_totals(rows, [F.desc("id")], ["v"]).orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = 0
    for i, r in enumerate(got, 1):
        total += r.v
        assert (r.position, r.id, r.v_upto) == (i, 1000 - i, total)
    assert total == got[0].v_all
