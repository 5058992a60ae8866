"""Benchmark decontamination: one Aho-Corasick automaton over the words of all test items scans each text once."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import keep_rows, kept, slices, words_of

# Most benchmark text of one automaton, which takes about a hundred times as much memory. A larger benchmark is cut into blocks of items.
BLOCK_BYTES = 1 << 20
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

HITS = "n_words long, hit array<struct<first:long,last:long>>, items array<string>"
_HIT = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    """Every run of `width` words; the whole if it is shorter, none if it is empty."""
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


class Scanner:
    """Finds where windows of items occur among the words of a text."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            for window in windows(words_of(text), width):
                key = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in window)
                owners.setdefault(key, set()).add("" if item_id is None else item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, names in owners.items():
            self.automaton.add_word(key, (len(key), tuple(sorted(names))))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[dict], set[str]]:
        """Joined runs of hit words, first and last inclusive, and the items whose windows occur."""
        hits: list[dict] = []
        found: set[str] = set()
        if self.empty or not words:
            return hits, found
        ids = self.ids
        for end, (length, names) in self.automaton.iter(tuple([ids.get(w, 0) for w in words])):
            found.update(names)
            first = end - length + 1
            while hits and hits[-1]["first"] >= first:
                hits.pop()
            if hits and first <= hits[-1]["last"] + 1:
                hits[-1]["last"] = end
            else:
                hits.append({"first": first, "last": end})
        return hits, found


@lru_cache(maxsize=1)
def _scanner(packed: bytes, width: int) -> Scanner:
    return Scanner(pickle.loads(zlib.decompress(packed)), width)


def _scan(block: Broadcast, width: int, key: str, only_hits: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(block.value, width)
        for batch in slices(batches):
            keep, counts, hits, items = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                hit, found = scanner.scan(words)
                if hit or not only_hits:
                    keep.append(i)
                    counts.append(len(words))
                    hits.append(hit)
                    items.append(sorted(found))
            columns = [batch.column(key).take(pa.array(keep, pa.int64())), pa.array(counts, pa.int64())]
            columns += [pa.array(hits, _HIT), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "hit", "items"])

    return scan


def _packed(items: DataFrame) -> bytes:
    return zlib.compress(pickle.dumps(sorted(map(tuple, items.collect()), key=repr)))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[DataFrame]:
    """The different items, all at once if their text is no larger than a block, else cut by hash into about that size."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= block_bytes:
        yield items
        return
    n = -(-size // block_bytes) * 2
    numbered = kept(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), "items")
    for k in range(n):
        yield numbered.where(F.col("block") == k).drop("block")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of each whole text lie inside an occurrence of a test item's window of `width` words.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; an item of fewer words is one window.
    A benchmark of up to `block_bytes` of text makes one automaton, broadcast, and documents are scanned in one narrow pass.
    A larger one is cut by hash into blocks of about that size, each scanned over all texts; hits are then merged by digest
    of the text, so nothing grows with the benchmark but the number of passes.

    Returns doc_id, n_words, hit (array of first and last word, joined where they touch), items (distinct ids as text,
    sorted), one row for each row of `docs`, also for null or repeated ids; a null text has no words. An item whose id
    is null is named by the empty string; a null item text has no windows; repeated items count once. Empty tables give no
    rows or no hits. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = list(_blocks(benchmark, block_bytes))
    if len(blocks) == 1:
        block = spark.sparkContext.broadcast(_packed(blocks[0]))
        return docs.select("doc_id", "text").mapInArrow(_scan(block, width, "doc_id", False), f"doc_id {kind}, {HITS}")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.select("doc_id", "text", digest.alias("digest"))
    texts = keyed.groupBy("digest").agg(F.any_value("text").alias("text"))
    found = None
    for items in blocks:
        block = spark.sparkContext.broadcast(_packed(items))
        part = kept(texts.mapInArrow(_scan(block, width, "digest", found is not None), f"digest binary, {HITS}"), "hits")
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("digest").agg(
        F.max("n_words").alias("n_words"),
        _joined(F.sort_array(F.flatten(F.collect_list("hit")))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return keyed.select("doc_id", "digest").join(merged, "digest").drop("digest")


def _joined(hits: Column) -> Column:
    """Sorted runs joined where they touch or overlap."""
    none = F.array().cast("array<struct<first:long,last:long>>")

    def add(runs: Column, x: Column) -> Column:
        end = F.element_at(runs, -1)
        longer = F.struct(end["first"].alias("first"), F.greatest(end["last"], x["last"]).alias("last"))
        return F.when(
            (F.size(runs) > 0) & (x["first"] <= end["last"] + 1), F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))
        ).otherwise(F.concat(runs, F.array(x)))

    return F.aggregate(hits, none, add)


def hit_count(hits: str = "hit"):
    """How many words the runs hold."""
    return F.expr(f"aggregate({hits}, 0L, (n, x) -> n + x.last - x.first + 1)")


def character_spans(text: str | None, hits: list) -> list[tuple[int, int]]:
    """The runs as character offsets of the original text, end exclusive.

    >>> character_spans("One, TWO; three.", [(1, 2)])
    [(5, 15)]
    """
    at = [m.span() for m in _WORD.finditer((text or "").translate(_LOWER))] if hits else []
    return [(at[first][0], at[last][1]) for first, last in hits]


def with_spans(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Contaminated rows with the character spans to report or cut out: doc_id, text, spans (end exclusive).

    Hits belong to texts, by digest, so rows with null or repeated ids are as good as others. Rows without a hit are left out.
    """
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.select("doc_id", "text", digest.alias("digest"))
    texts = keyed.groupBy("digest").agg(F.any_value("text").alias("text")).withColumnRenamed("digest", "doc_id")
    hits = benchmark_hits(texts, benchmark, width, block_bytes).where(F.size("hit") > 0)
    hits = hits.select(F.col("doc_id").alias("digest"), "hit")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pairs = zip(batch.column("text").to_pylist(), batch.column("hit").to_pylist())
            spans = [
                [{"start": a, "end": b} for a, b in character_spans(t, [(h["first"], h["last"]) for h in hit])] for t, hit in pairs
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(spans, kind)], ["doc_id", "text", "spans"]
            )

    joined = keyed.join(hits, "digest").select("doc_id", "text", "hit")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(locate, f"doc_id {kind}, text string, spans array<struct<start:long,end:long>>")


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all their columns, whose text holds no window of a benchmark item.

    A null or empty text is clean; repeated rows fare alike; other columns, of whatever names, pass through. Items without
    words, and an empty benchmark, take nothing away; an empty table stays empty. One narrow pass a block of the benchmark: what
    is left after one block is scanned for the next.
    """

    def without(block: Broadcast):
        def decider():
            scanner = _scanner(block.value, width)
            return lambda texts: [not scanner.scan(words_of(t))[0] for t in texts]

        return decider

    blocks = list(_blocks(benchmark, block_bytes))
    for i, items in enumerate(blocks):
        docs = keep_rows(docs, without(docs.sparkSession.sparkContext.broadcast(_packed(items))))
        if i + 1 < len(blocks):
            docs = kept(docs, "clean")
    return docs
