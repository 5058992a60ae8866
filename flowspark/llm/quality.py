"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.boosting import Forest, fit
from flowspark.llm.common import in_fold, keep_rows, slices

# The most labelled documents that the classifier learns from: those with the smallest hash of their id.
MOST_LABELLED = 20_000

_LETTERS = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGITS = np.array([48 <= b <= 57 for b in range(256)])
_SPACES = np.array([b in b" \t\r\n" for b in range(256)])
_STOPS = np.array([b in b".,;:" for b in range(256)])
_MARKS = np.array([33 <= b < 127 and not chr(b).isalnum() and b not in b".,;:" for b in range(256)])
_NON_ASCII = np.array([b >= 128 for b in range(256)])


def statistics(text: str | None) -> list[float]:
    """What the classifier sees of a text: sizes, character classes, repetition, shape of words and lines.

    Null and empty texts have zeros.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    if n == 0:
        return [0.0] * len(NAMES)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = hist[hist > 0] / n
    letters = hist[_LETTERS].sum()
    words = data.split()
    w = len(words)
    counts = Counter(words)
    top = counts.most_common(2)
    lengths = np.fromiter(map(len, words), np.int64, w)
    lines = [x for x in data.split(b"\n") if x]
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    packed = sum(len(zlib.compress(data[i : i + 65536], 1)) for i in range(0, n, 65536))
    initials = Counter(x[0] for x in words)
    return [
        float(np.log1p(n)),
        float(np.log1p(w)),
        letters / n,
        hist[_UPPER].sum() / max(letters, 1),
        hist[_DIGITS].sum() / n,
        hist[_SPACES].sum() / n,
        hist[_STOPS].sum() / n,
        hist[_MARKS].sum() / n,
        hist[33] / n,
        hist[_NON_ASCII].sum() / n,
        float(-(share * np.log2(share)).sum()),
        float(lengths.mean()) if w else 0.0,
        float(lengths.std()) if w else 0.0,
        float(lengths.max()) if w else 0.0,
        float((lengths <= 3).mean()) if w else 0.0,
        len(counts) / max(w, 1),
        top[0][1] / w if w else 0.0,
        top[1][1] / w if len(top) > 1 else 0.0,
        pairs / max(w - 1, 1),
        same / max(w - 1, 1),
        packed / n,
        len(lines) / max(w, 1),
        len(set(lines)) / max(len(lines), 1),
        sum(c for b, c in initials.items() if 65 <= b <= 90) / max(w, 1),
    ]


NAMES = (
    "log_bytes log_words letters upper digits spaces stops marks exclamations non_ascii entropy word_mean word_deviation "
    "word_longest short_words distinct_words top_word second_word distinct_pairs repeats compression lines distinct_lines "
    "capitalised"
).split()


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Forest:
    """Fit on labelled documents whose crc32(id as text) mod 5 is not 0, at most `most` of them.

    `labels` has doc_id and quality (0 or 1; others are left out, as are null ids). Conflicting labels of an id average;
    of several texts of an id one is taken. Labels are sampled by hash of the id, so every size and order gives the same.
    """
    train = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~in_fold(5, 0))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("y"), pa.array(rows, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "y", "x"])

    # At most `most` ids are broadcast.
    chosen = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")
    described = chosen.mapInArrow(describe, f"doc_id {kind}, y double, x array<double>")
    rows = described.groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("one")).select("doc_id", "one.*").orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(NAMES))
    return fit(x, np.array([r["y"] for r in rows], np.float64))


def scores(forest: Forest, texts: list[str | None]) -> np.ndarray:
    """The score of each text."""
    x = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))
    return forest.score(x)


def score_quality(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """Score every row's whole text, in one narrow pass.

    Returns doc_id, held_out, score (0 to 1, higher: quality likelier), predicted (1 from `threshold` on), one row for each
    row of `docs`, also for null or repeated ids. Null and empty texts are scored by statistics of zero; a null id is not
    held out. Other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = pa.array(scores(forest, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", in_fold(5, 0).alias("held_out"), "score", predicted.alias("predicted"))


def keep_quality(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, that are not rejected.

    A null or empty text is scored by statistics of zero and stays or goes by that score; repeated rows fare alike; other columns,
    of whatever names, pass through. An empty table stays empty.
    """
    return keep_rows(docs, lambda: lambda texts: (scores(forest, texts) >= threshold).tolist())
