"""From raw documents to token ids: five stages, each over all that the one
before kept. Every stage but the last returns the columns of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chosen_path, mixing, substrings, toxicity
from millrace.llm.queries import MIX_WEIGHTS, source_domain, tokenizer_path
from millrace.sources.scratch import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.learn_and_score(docs.select(*COLUMNS), labels).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return chosen_path.keep_first(docs.select(*COLUMNS), shingle=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of an earlier document go; documents without any other word too."""
    rows = substrings.remove_repeats(docs.select(*COLUMNS))
    text = F.coalesce("left_text", "text")
    return rows.where("n_removed = 0 or n_removed < n_words").select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("n_removed") > 0, F.length(text).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as are left, by the weights of the mix; a document comes once
    for each epoch that uses it, and is cut where the budget of its leaf ends."""
    rows = mixing.mix(docs.select(*COLUMNS), source_domain(), MIX_WEIGHTS)
    n_chars = F.when(F.col("cut"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", n_chars).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    rows = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(), keep=["doc_id", "lang", "source"])
    return rows.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substrings", drop_repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Classifier, similarity join and merges are beyond SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
