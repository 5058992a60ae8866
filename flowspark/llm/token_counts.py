"""Token counts through a digest cache: a text that was counted once, under the same tokenizer, is never encoded again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import kept, slices
from flowspark.llm.encoding import encoder

CACHE = "digest binary, n_tokens long, tokenizer string"
# Up to so many digests (32 bytes each) are broadcast to find their texts; beyond, the texts are shuffled by digest.
BROADCAST_DIGESTS = 100_000


def tokenizer_digest(path: str) -> str:
    """Of the tokenizer's file and the library's version: counts of another of either are never mixed in."""
    return hashlib.sha256(Path(path).read_bytes() + tokenizers.__version__.encode()).hexdigest()


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches):
            counts = [len(ids) // 4 for ids in encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """Tokens of every row's whole text, by joining content and tokenizer digests to the counts stored at `cache_path`.

    The content is normalised as far as the count allows: null is the empty text, else the exact bytes, since a byte-level
    tokenizer tells apart whatever else one might fold. Texts that the cache lacks are made distinct, each is encoded once,
    and the counts are appended; the cache is created when absent. Copies are folded before the shuffle, so a large group
    of copies costs one text a task. A count appended twice, as by two jobs at a time, does no harm.

    Returns doc_id, n_bytes (UTF-8), n_tokens, digest: one row for each row of `docs`, also for null or repeated ids. An
    empty text has 0 tokens. Other columns of `docs` are not read. An empty table gives none and leaves the cache as it is.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache_path)

    def cached() -> DataFrame:
        stored = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
        return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    lacking = kept(keyed.select("digest").distinct().join(cached(), "digest", "left_anti"), "lacking")
    n_lacking = lacking.count()
    if n_lacking:
        wanted = keyed.select("digest", "text")
        if n_lacking <= BROADCAST_DIGESTS:
            wanted = wanted.join(F.broadcast(lacking), "digest", "left_semi")
        texts = wanted.groupBy("digest").agg(F.any_value("text").alias("text"))
        if n_lacking > BROADCAST_DIGESTS:
            texts = texts.join(lacking, "digest", "left_semi")
        counted = texts.mapInArrow(_count(tokenizer_path), "digest binary, n_tokens long")
        counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    return (
        keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(cached(), "digest", "left")
        .select("doc_id", "n_bytes", "n_tokens", "digest")
    )
