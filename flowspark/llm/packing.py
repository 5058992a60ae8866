"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths, equal lengths share a bucket."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import slices
from flowspark.llm.encoding import encoder

END_ID = 1


def binary_lengths(n: int, longest: int) -> list[int]:
    """Pieces of `longest` (a power of two), then the powers of two of the rest, falling: they add up to n.

    >>> binary_lengths(13, 4)
    [4, 4, 4, 1]
    """
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 2048, end_id: int = END_ID) -> DataFrame:
    """Cut every row's token ids and one end id into pieces whose lengths are powers of two, at most `longest`.

    Each piece is a sequence of its own, so no sequence crosses documents, attention never sees another document, and none
    is padded; a training batch draws sequences from one `bucket`, which all have the same length.
    One narrow pass: no shuffle, a task holds one slice of texts.

    Returns doc_id, start, length, bucket (= length), doc_tokens, sequence_id, offset (0), ids (little-endian unsigned
    32-bit). A null text is empty: it packs its end id alone. Rows are packed one by one, so null or repeated ids and
    repeated rows are packed as often as they occur. Other columns of `docs` are not read. An empty table packs to none.
    """
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in slices(batches):
            rows: list[tuple] = []
            doc_type = batch.schema.field("doc_id").type
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids += end
                n, start = len(ids) // 4, 0
                for length in binary_lengths(n, longest):
                    rows.append((doc_id, start, length, n, ids[4 * start : 4 * (start + length)]))
                    start += length
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (doc_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary"
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.col("length").alias("bucket"),
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )
