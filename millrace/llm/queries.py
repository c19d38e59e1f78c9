"""One query per operator, over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chosen_path, count_tree, divergence, filter_audit, licenses, mixing, outliers, sharding, substrings, token_files, topk, toxicity
from millrace.llm.oracles import ORACLES
from millrace.sources.scratch import scratch_path

VOCABULARY = "word_bpe_49k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_words(text: str = "text") -> Column:
    """A text's words joined by one space."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.regexp_replace(trimmed, r"[\x20\x09-\x0D]+", " ")


# What the mix should be made of, in parts; a name that is not listed has one.
MIX_WEIGHTS = {
    "domain": {"web": 4, "books": 3, "code": 2, "news": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}


def source_domain() -> Column:
    """A domain for each source; the tables have none of their own."""
    digit = F.substring(F.md5(F.coalesce(F.col("source"), F.lit("")).cast("binary")), 1, 1)
    return F.when(digit < "4", "web").when(digit < "8", "books").when(digit < "c", "code").otherwise("news")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, mixed by weights."""
    return mixing.select_documents(_table(spark, sf_dir, "documents"), source_domain(), MIX_WEIGHTS)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    rows = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, keep=["doc_id"]), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


SHARDS = 16


def op3_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in shards by source; resharding makes the bytes equal."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    by_source = F.pmod(F.xxhash64("source"), F.lit(SHARDS))
    old = sharding.write_shards(docs, by_source, SHARDS, scratch_path(spark, "shards"))
    new = sharding.reshard_bytes(spark, old, SHARDS, scratch_path(spark, "resharded"))
    rows = new.read(spark).select(
        "doc_id",
        sharding.text_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
    )
    return sharding.with_slots(rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.learn_and_score(docs, _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return rows.select("doc_id", "held_out", "score", "predicted")


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outliers.judge(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("left_text", plain_words()), 256).alias("kept_sha256")
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.id_checksums(token_files.read_token_files(spark, folder))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.usable_vectors(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tree.jaccard_join(_table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_flow_resharding": op3_flow_resharding,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_robust_outliers": op6_robust_outliers,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_files": op9_token_files,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_filter_interaction": op11_filter_interaction,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_source_divergence": op13_source_divergence,
}
