"""Linear regression with train/validation tuning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.caching import cached, in_few_tasks
from millrace.operators.relational import parts_of, with_random

# The grid and the share of the training rows used for fitting.
REG_PARAMS = (10000.0, 100.0, 0.1)
TRAIN_RATIO = 0.8


def fit_linear(df: DataFrame, **params) -> LinearRegressionModel:
    """Least squares over (features, label)."""
    return LinearRegression(**params).fit(df)


@dataclass
class Tuned:
    """The candidates with their metric on the validation rows, and the best one
    fitted again on all rows."""

    reg_params: list[float]
    metrics: list[float]
    best: int
    model: LinearRegressionModel

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows)


# Metrics of which more is better.
_MORE_IS_BETTER = ("r2", "var")


def tune_linear(
    train: DataFrame,
    reg_params: Sequence[float] = REG_PARAMS,
    metric: str = "rmse",
    train_ratio: float = TRAIN_RATIO,
    seed: int = 12345,
    key: str | Column | None = None,
    parallelism: int = 3,
) -> Tuned:
    """Fit each regParam on a share of the rows, score the rest, refit the best on
    all rows (the first of equal ones). Candidates run side by side.

    Which rows validate is a stored random number; with a unique `key` it is the same
    on every run and any number of cores.
    """
    columns = [F.col(c) for c in ("features", "label")]
    if key is None:
        rows = with_random(train.select(*columns), seed)
    else:
        rows = with_random(train.withColumn("_key", F.col(key) if isinstance(key, str) else key), seed, "_key")
    with cached(rows.select(*columns, "random")) as held:
        fit_on, score_on = parts_of(in_few_tasks(held), (train_ratio, 1 - train_ratio))
        evaluator = RegressionEvaluator(metricName=metric)

        def score(reg_param: float) -> float:
            return evaluator.evaluate(fit_linear(fit_on, regParam=float(reg_param)).transform(score_on))

        with ThreadPool(parallelism) as pool:
            metrics = pool.map(inheritable_thread_target(train.sparkSession)(score), reg_params)
        best = metrics.index(max(metrics) if metric in _MORE_IS_BETTER else min(metrics))
        model = fit_linear(in_few_tasks(held).drop("random"), regParam=float(reg_params[best]))
    return Tuned([float(r) for r in reg_params], metrics, best, model)


def tuning_report(spark: SparkSession, tuned: Tuned) -> DataFrame:
    """(reg_param, metric, is_best), one row per candidate."""
    rows = [(r, float(m), i == tuned.best) for i, (r, m) in enumerate(zip(tuned.reg_params, tuned.metrics))]
    return spark.createDataFrame(rows, "reg_param double, metric double, is_best boolean")


def linear_report(
    spark: SparkSession, model: LinearRegressionModel, names: Sequence[str]
) -> DataFrame:
    """(term, coefficient, reg_param), one row per feature and the intercept."""
    terms = list(zip(names, map(float, model.coefficients), strict=True))
    terms.append(("(intercept)", float(model.intercept)))
    reg_param = float(model.getRegParam())
    return spark.createDataFrame(
        [(*t, reg_param) for t in terms], "term string, coefficient double, reg_param double"
    )
