"""Logistic regression over encoded features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.caching import cached, in_few_tasks
from millrace.operators.features import feature_pipeline

# The solver parameters of the classification job.
MAX_ITER = 10
REG_PARAM = 0.3
ELASTIC_NET = 0.8
FAMILY = "multinomial"
# The solver's own default.
TOLERANCE = 1e-6


def fit_logistic(
    train: DataFrame,
    categorical: Sequence[str],
    inputs: Sequence[str],
    label: str = "label",
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    elastic_net: float = ELASTIC_NET,
    family: str = FAMILY,
    tolerance: float = TOLERANCE,
) -> PipelineModel:
    """Encoders and classifier, all fitted on the training rows."""
    classifier = LogisticRegression(
        labelCol=label,
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=elastic_net,
        family=family,
        tol=tolerance,
    )
    with cached(train) as held:
        return feature_pipeline(categorical, inputs, classifier).fit(in_few_tasks(held))


def logistic_report(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(class, position, coefficient); position -1 is the intercept."""
    fitted = model.stages[-1]
    matrix = fitted.coefficientMatrix.toArray()
    rows = []
    for cls, intercept in enumerate(fitted.interceptVector):
        rows.append((cls, -1, float(intercept)))
        rows.extend((cls, i, float(v)) for i, v in enumerate(matrix[cls]))
    return spark.createDataFrame(rows, "class int, position int, coefficient double")


def score_logistic(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns with `prediction`, the probability of class 1 (NULL if the
    model knows one class only) and those of all classes."""
    return model.transform(rows).select(
        *keep,
        "prediction",
        F.get(vector_to_array("probability"), 1).alias("probability"),
        vector_to_array("probability").alias("probabilities"),
    )
