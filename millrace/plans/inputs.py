"""Graph, point, vector, regression and classification inputs, derived from
the orders, customer, lineitem, embeddings and documents tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COORDS = ["x", "y", "z", "w"]
REFERENCE_DATE = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed graph of customers: from the buyer of a pending order to the
    buyer of the next order."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where(F.col("o_orderstatus") == "P").select(
        (F.col("o_orderkey") + 1).alias("next"), F.col("o_custkey").alias("src")
    )
    second = orders.select(F.col("o_orderkey").alias("next"), F.col("o_custkey").alias("dst"))
    return (
        first.join(second, "next")
        .where(F.col("src") != F.col("dst"))
        .select("src", "dst")
        .distinct()
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, x, y, z, w): four scaled facts per customer with orders."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("y"),
            (F.avg("o_totalprice") / 10000).alias("z"),
            F.max("o_orderdate").alias("last"),
        )
    )
    days = F.datediff(F.lit(REFERENCE_DATE).cast("date"), F.col("last").cast("date"))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .select("c_custkey", "x", "y", "z", (days / 100).alias("w"))
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, embedding) with 64 floats each."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


REGRESSION_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: price as label, three numeric features."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"), *REGRESSION_FEATURES
    )


BINARY_CATEGORIES = ["o_orderpriority", "c_mktsegment"]
BINARY_INPUTS = ["o_totalprice", "o_orderpriority", "c_mktsegment", "c_acctbal"]


def binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer: label 1 for fulfilled orders."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        *BINARY_INPUTS,
    )


DOCUMENT_CATEGORIES = ["lang", "source"]
DOCUMENT_INPUTS = ["n_chars", "lang", "source"]


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: quality as label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", *DOCUMENT_INPUTS)
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return documents.join(labels, "doc_id").select("doc_id", "label", *DOCUMENT_INPUTS)


def fixed_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_totalprice, prediction, label): a rule in place of a model."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        (F.col("o_totalprice") > 150000).cast("double").alias("prediction"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
    )


def text_of(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as comma-separated lines, column `value`."""
    parts = [F.col(c).cast("string") for c in columns]
    return df.select(reduce(lambda a, b: F.concat(a, F.lit(","), b), parts).alias("value"))
