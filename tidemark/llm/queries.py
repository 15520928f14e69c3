"""Registered queries: one per operator, each over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import align_tokenizers
from tidemark.llm.decontam import decontaminate
from tidemark.llm.importance import resample
from tidemark.llm.jaccard import cluster_documents
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.lm import score_texts
from tidemark.llm.mixing import mix_sources
from tidemark.llm.quality import classify
from tidemark.llm.quality_rules import apply_rules
from tidemark.llm.sharding import shuffle_into_shards
from tidemark.llm.spotsigs import compare_neighbours
from tidemark.llm.substring_dedup import dedup_substrings
from tidemark.llm.token_records import write_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "source", "lang", "n_words", "p_junk", "p_toxic", "keep")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    out = score_texts(docs.withColumn("held_out", held_out), train="NOT held_out")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shuffle_into_shards(docs, shards=24)
    return out.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.concat_ws(",", "items"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", sha.alias("items_sha256"), "contaminated")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    records = write_records(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return records.read().select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "tokens", "probability", "weight")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = resample(docs, table(spark, sf_dir, "benchmark"), percent=10, max_n=1, buckets=10_000, min_words=20, columns=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, *[public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")], columns=["doc_id"])


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunk_share", "reason")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_sharding": op5_sharding,
    "op6_decontamination": op6_decontamination,
    "op7_token_records": op7_token_records,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_spotsigs": op10_spotsigs,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_quality_rules": op13_quality_rules,
}
