"""The corpus pipeline: stages applied one after another to ``documents``.

Each stage gets what its predecessor kept, written as Parquet and read again.
All stages but the last return the columns of their input; the last adds size,
shard, bucket, slot and grown_shard.

Null text and empty text have no words: the first stage rejects them. Of rows
that share an id and of near copies the third stage sees one; rows with a null
id are told apart by their texts. Very long texts are worked on whole. Ties (of
near copies, of drawn documents) go to the least id and to hashes of the rows,
so a run on the same tables gives the same rows. Empty tables give an empty
result; without labels nothing but texts without words is rejected. Extra
columns, whatever their names, come through all stages; those named as the last
stage's own are replaced there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import scratch, shared_dir
from tidemark.llm.decontam import decontaminate
from tidemark.llm.jaccard import keep_one
from tidemark.llm.mixing import mix_sources
from tidemark.llm.quality import classify
from tidemark.llm.sharding import shuffle_into_shards

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds neither junk nor toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).filter("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).filter("NOT contaminated").select(*docs.columns)


#: Targets of the mixing stage, as powers of each dimension's own shares: large sources and languages give way a little.
MIX = {"source": 0.9, "lang": 0.9, "topic": 1.0}


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the tokens of sources, languages and topics have their target shares (in expectation).

    No document counts more than once, so as much is kept as no cell would have to be drawn more often than that.
    """
    return mix_sources(docs, MIX, keep_share=None).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, shuffled into shards: their columns with size, shard, bucket, slot and grown_shard."""
    return shuffle_into_shards(docs, shards=24)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_sources", mixing),
    ("sharding", sharding),
]

#: A fitted classifier, components and seeded permutations are beyond SQL; tests/llm holds the run against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        with scratch(spark):  # a stage's own tables go once its rows are written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
