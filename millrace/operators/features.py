"""Feature vectors: assembling, indexing, one-hot encoding, pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranks import RankIndexer


def assemble(
    df: DataFrame,
    columns: Sequence[str],
    output: str = "features",
    handle_invalid: str = "error",
) -> DataFrame:
    """Numeric and vector columns side by side in one vector; NULL and NaN are
    errors unless `handle_invalid` says otherwise."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid
    ).transform(df)


def array_features(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """An array<float|double> column as vector column."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def spread_vector(df: DataFrame, column: str, width: int, prefix: str = "f") -> DataFrame:
    """Replace a vector column by `width` double columns."""
    values = vector_to_array(column)
    others = [F.col(c) for c in df.columns if c != column]
    return (
        df.select(*others, values.alias("_values"))
        .select(*others, *[F.col("_values")[i].alias(f"{prefix}{i}") for i in range(width)])
    )


def rank_indexer(columns: Sequence[str]) -> RankIndexer:
    """Category -> index by descending frequency, ties alphabetical, for any number
    of categories; an unseen category is an error."""
    return RankIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns])


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Index -> indicator vector; the last category is all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_vector" for c in columns],
    )


def index_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `<column>_index`."""
    return rank_indexer(columns).fit(df).transform(df)


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `<column>_index` and `<column>_vector`, sparse vectors as wide as the
    column has categories, less one."""
    indexed = index_categories(df, columns)
    return one_hot_encoder(columns).fit(indexed).transform(indexed)


def feature_pipeline(
    categorical: Sequence[str],
    inputs: Sequence[str],
    estimator: Estimator | None = None,
    output: str = "features",
) -> Pipeline:
    """Indexer, encoder, assembler and optionally an estimator.

    `inputs` names the features in order; a categorical one stands for its
    indicator vector. One multi-column stage replaces a stage per column.
    """
    names = [f"{c}_vector" if c in categorical else c for c in inputs]
    stages = [
        rank_indexer(categorical),
        one_hot_encoder(categorical),
        VectorAssembler(inputCols=names, outputCol=output),
    ]
    return Pipeline(stages=[*stages, estimator] if estimator else stages)
