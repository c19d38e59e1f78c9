"""Model quality: silhouette, regression metrics, accuracy, confusion, ROC."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import running_totals


def silhouette(
    df: DataFrame, features: str = "features", prediction: str = "cluster"
) -> DataFrame:
    """One row: the mean squared-Euclidean silhouette. The work is rows x
    clusters, from per-cluster totals; no pairs of rows are formed."""
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=prediction)
    value = float(evaluator.evaluate(df))
    return df.sparkSession.createDataFrame([(value,)], "silhouette double")


def regression_metrics(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """One row (rmse, mse, mae, r2), in one aggregate. r2 is NULL where the label is
    constant."""
    error = F.col(label) - F.col(prediction)
    mse = F.avg(error * error)
    return df.agg(
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(label))).alias("r2"),
    )


def confusion_matrix(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """(prediction, label, n)."""
    return df.groupBy(prediction, label).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: the share of equal pairs."""
    same = (F.col(prediction) == F.col(label)).cast("double")
    return df.agg(F.avg(same).alias("accuracy"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def roc_curve(df: DataFrame, score: str = "prediction", label: str = "label") -> DataFrame:
    """(position, threshold, fpr, tpr): (0, 0) first, one point per distinct
    score from the highest down, (1, 1) last. A label above 0.5 is positive.

    Every score is counted once before the running totals, so neither many
    scores nor many rows of one score meet in a single task.
    """
    positive = F.col(label) > 0.5
    counts = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    totals = running_totals(counts, [F.desc("threshold")], ["pos", "neg"])
    points = totals.select(
        "position",
        "threshold",
        _share(F.col("neg_upto"), F.col("neg_all")).alias("fpr"),
        _share(F.col("pos_upto"), F.col("pos_all")).alias("tpr"),
    )
    end = totals.agg((F.count(F.lit(1)) + 1).alias("last")).select(
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("position"), F.lit(0.0).alias("at")),
                F.struct(F.col("last").alias("position"), F.lit(1.0).alias("at")),
            )
        )
    )
    ends = end.select(
        "position",
        F.lit(None).cast("double").alias("threshold"),
        F.col("at").alias("fpr"),
        F.col("at").alias("tpr"),
    )
    return points.unionByName(ends)
