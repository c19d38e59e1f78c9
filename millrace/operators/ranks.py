"""Indexing categories by their frequency, with the ranks as distributed tables."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordering import running_totals
from millrace.sources.scratch import scratch_path

# The most frequent values, met by a broadcast; any other value holds less than
# this share of the rows, so none is a hot key of the shuffle.
POPULAR = 1000
_RANKS = "value string, rank double"


class RankIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Category -> index by descending frequency, ties by value, as the library's
    indexer gives them, for any number of values: none of them reach the driver."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RankIndexerModel:
        spark = dataset.sparkSession
        paths = []
        for column in self.getInputCols():
            value = F.col(column).cast("string")
            counts = dataset.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            ranks = running_totals(counts, [F.desc("n"), F.asc("value")], [])
            paths.append(scratch_path(spark, "ranks"))
            ranks.select("value", (F.col("position") - 1).cast("double").alias("rank")).write.parquet(paths[-1])
        model = RankIndexerModel(paths)
        return self._copyValues(model)


class RankIndexerModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """The rank tables of the input columns. A NULL or a value without a rank is an
    error when its row is computed."""

    def __init__(self, paths: list[str] | None = None):
        super().__init__()
        self.paths = paths or []

    def ranks(self, column: str) -> DataFrame:
        """(value, rank) of an input column."""
        path = self.paths[self.getInputCols().index(column)]
        return SparkSession.getActiveSession().read.schema(_RANKS).parquet(path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, output in zip(self.getInputCols(), self.getOutputCols()):
            dataset = self._indexed(dataset, column, output)
        return dataset

    def _indexed(self, rows: DataFrame, column: str, output: str) -> DataFrame:
        ranks = self.ranks(column)
        popular = ranks.where(F.col("rank") < POPULAR).select(F.col("value").alias("_v"), F.col("rank").alias("_popular"))
        others = ranks.where(F.col("rank") >= POPULAR).select(
            F.col("value").alias("_w"), F.col("rank").alias("_other"), F.lit(0).alias("_none")
        )
        value = F.col(column).cast("string")
        # Rows that are done take no part in the second join: spread, not one key.
        done = F.col("_popular").isNotNull()
        missing = F.raise_error(F.concat(F.lit(f"no rank in column {column}: "), F.coalesce(value, F.lit("NULL"))))
        return (
            rows.join(F.broadcast(popular), value == F.col("_v"), "left")
            .withColumn("_rest", F.when(~done, value))
            .withColumn("_spread", F.when(done, F.spark_partition_id() + 1).otherwise(0))
            .join(others, (F.col("_rest") == F.col("_w")) & (F.col("_spread") == F.col("_none")), "left")
            .withColumn(output, F.coalesce("_popular", "_other", missing.cast("double")))
            .drop("_v", "_popular", "_rest", "_spread", "_w", "_other", "_none")
        )

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: RankIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, column in enumerate(self.model.getInputCols()):
            self.model.ranks(column).write.parquet(f"{path}/ranks-{i}")


class _ModelReader(MLReader):
    def load(self, path: str) -> RankIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = RankIndexerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.paths = [f"{path}/ranks-{i}" for i in range(len(model.getInputCols()))]
        return model
