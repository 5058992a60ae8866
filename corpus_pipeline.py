"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what its predecessor kept, with the columns of `documents`, and works on all of it. Null, empty and repeated
rows, empty tables and further columns, of whatever names, are dealt with as each stage's operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm import langid, quality
from flowspark.llm.common import kept, shipped
from flowspark.llm.dart_minhash import keep_one
from flowspark.llm.decontaminate import keep_clean
from flowspark.llm.packing import pack


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on labelled ones, rejects: see `keep_quality` for null and empty texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_quality(docs, quality.learn(docs, labels))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, null texts among them, and those too far from every language."""
    return langid.keep_identified(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies; null and empty texts are copies of each other."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item; texts without words stay."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents cut into sequences of power-of-two lengths, none padded, none across documents; null texts are empty."""
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality classifier", shipped(quality_classifier)),
    ("language ID", shipped(language_id)),
    ("near-dedup", shipped(near_dedup)),
    ("benchmark decontamination", shipped(benchmark_decontamination)),
    ("packing", shipped(packing)),
]

# Trained models and tokenizers are beyond SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each but the last written and read again, so that none is computed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
