"""Ranked lexical search by pipelined term partitioning.

Terms have owners, rare terms first. Items travel in bundles from owner to owner, each bundle with the documents of one shard
that it has met and the sum of what their terms contributed. A stage is a cogroup of bundles and one owner's postings.
Sums are integers, so their order doesn't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import kept, slices, words_of

# Documents of a shard at most, and items of a bundle block on average: together they bound a group of a stage.
SHARD_DOCS = 16_384
BLOCK_ITEMS = 256
# An owner has the terms that up to this share of the documents holds, and the last one the others.
OWNERS = (1 / 256, 1 / 32, 1 / 8)
# Bits of the filter that keeps other terms than those of items out of the index. Its size doesn't depend on the items.
FILTER_BITS = 1 << 22
# Different words whose membership a task remembers.
_REMEMBERED = 1 << 20

_INTS = pa.list_(pa.int32())


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for item, block, text in zip(*(batch.column(n).to_pylist() for n in ("item", "block", "text")), strict=True):
            rows += [(item, block, term, times) for term, times in Counter(words_of(text)).items()]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "block", "term", "times"])


class _Shard:
    """Postings of some documents while they are gathered."""

    def __init__(self):
        self.ids, self.sizes = [], []
        self.postings: dict[bytes, tuple[list[int], list[int]]] = {}

    def batches(self, number: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """One row of documents (no term) and a row for each term. Places in a shard are in order of the ids, nulls first."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is not None, self.ids[i] if self.ids[i] is not None else 0))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        sizes = np.array(self.sizes, np.int32)
        terms, columns = [None], ([None], [None], [None])
        for term, (docs, times) in self.postings.items():
            terms.append(term)
            docs = np.array(docs)
            for column, values in zip(columns, (place[docs], np.array(times, np.int32), sizes[docs]), strict=True):
                column.append(values)
        ids = pa.array([[self.ids[i] for i in order], *[None] * (len(terms) - 1)], pa.list_(kind))
        total = pa.array([int(sizes.sum(dtype=np.int64)), *[None] * (len(terms) - 1)], pa.int64())
        arrays = [pa.array([number] * len(terms), pa.int64()), pa.array(terms, pa.binary()), *(pa.array(c, _INTS) for c in columns)]
        whole = pa.RecordBatch.from_arrays([*arrays, ids, total], ["shard", "term", "docs", "times", "sizes", "ids", "total"])
        for start in range(0, whole.num_rows, 4096):
            yield whole.slice(start, 4096)


def _index(bits: bytes, shard_docs: int):
    """Inverted lists of each shard, for terms that pass the filter, made where the texts are read."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = np.unpackbits(np.frombuffer(bits, np.uint8))
        known: dict[bytes, bool] = {}
        number = TaskContext.get().partitionId() << 32
        shard, kind = _Shard(), None
        for batch in slices(batches):
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                at = len(shard.ids)
                shard.ids.append(doc_id)
                shard.sizes.append(len(words))
                for term, times in Counter(words).items():
                    wanted = known.get(term)
                    if wanted is None:
                        if len(known) >= _REMEMBERED:
                            known.clear()
                        wanted = known[term] = bool(passing[zlib.crc32(term) % FILTER_BITS])
                    if wanted:
                        held = shard.postings.get(term)
                        if held is None:
                            held = shard.postings[term] = ([], [])
                        held[0].append(at)
                        held[1].append(times)
                if len(shard.ids) >= shard_docs:
                    yield from shard.batches(number, kind)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield from shard.batches(number, kind)

    return index


def contributions(times: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) for each posting, m being 100 - 75 + ((75 n N) div L)."""
    sizes, which = np.unique(sizes, return_inverse=True)
    m = np.array([25 + 75 * int(n) * n_docs // n_terms for n in sizes], np.int64)[which]
    tf = times.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _stage(stage: int, top: int, n_docs: int, n_terms: int):
    """Adds what one owner's terms contribute in one shard to the bundles of one block."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        adds: dict[int, list[tuple[int, int]]] = {}
        lists = []
        for i in range(postings.num_rows):
            docs, times, sizes = (postings[n][i].values.to_numpy(zero_copy_only=False) for n in ("docs", "times", "sizes"))
            lists.append((docs, contributions(times, sizes, n_docs, n_terms)))
            for wanted in postings["items"][i].as_py():
                adds.setdefault(wanted["item"], []).append((i, wanted["add"]))
        width = max((int(docs.max()) + 1 for docs, _ in lists), default=0)
        out_docs, out_sums = [], []
        for i in range(bundles.num_rows):
            docs, sums = (bundles[n][i].values.to_numpy(zero_copy_only=False) for n in ("docs", "sums"))
            wanted = adds.get(bundles["item"][i].as_py())
            if wanted:
                dense = np.zeros(max(width, int(docs.max()) + 1 if len(docs) else 0), np.int64)
                dense[docs] = sums
                for place, add in wanted:
                    dense[lists[place][0]] += add * lists[place][1]
                docs = np.flatnonzero(dense)
                sums = dense[docs]
            rest = bundles["rest"][i][stage].as_py()
            if len(docs) > top:
                # What can't reach the top of this shard any more can't reach the whole top either.
                least = np.partition(sums, len(sums) - top)[len(sums) - top]
                stay = sums + rest >= least
                docs, sums = docs[stay], sums[stay]
                if rest == 0:
                    best = np.lexsort((docs, -sums))[:top]
                    docs, sums = docs[best], sums[best]
            out_docs.append(docs.astype(np.int32))
            out_sums.append(sums)
        columns = {n: bundles[n] for n in ("block", "shard", "item", "rest")}
        return pa.table({**columns, "docs": pa.array(out_docs, _INTS), "sums": pa.array(out_sums, pa.list_(pa.int64()))})

    return run


def ranked(docs: DataFrame, items: DataFrame, top: int = 10, shard_docs: int = SHARD_DOCS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The `top` best documents for each item by a sum of integer contributions of the terms they share.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. With N documents that have terms, L terms
    in all of them, df documents that hold a term, tf occurrences and n terms in a document: a term weighs
    floor(1000 ln((2N+2)/(2df+1))), and adds that times (10^9 tf) div (1000 tf + 8 (25 + (75 n N) div L)) as often as
    the item repeats it.

    Documents are indexed in shards where they are read, for terms that pass a filter of fixed size made of the items' terms.
    Bundles of about `block_items` items then pass the owners of terms, rarest first; after a stage a bundle drops documents
    that what is left can't lift into the top of their shard, which no document of the whole top is among. So a stage holds one
    shard's postings and sums of one block, and what travels gets less. Postings meet items by term: a common term has a
    row a shard, and adaptive execution splits it if items are too many to broadcast.

    Returns item_id, rank (from 1, equal scores by ascending doc_id, null first, then as indexed), doc_id, score, for scores above 0.
    Null and empty texts have no terms. Rows that repeat a doc_id are ranked each, rows that repeat an item_id are items
    of their own. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    numbered = items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    numbered = kept(numbered, "items")
    blocks = max(1, -(-numbered.count() // block_items))
    blocked = numbered.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    terms = kept(blocked.select("item", "block", "text").mapInArrow(_item_terms, "item long, block long, term binary, times long"), "terms")

    bits = np.zeros(FILTER_BITS, np.uint8)
    places = terms.select((F.crc32("term") % FILTER_BITS).cast("int").alias("bit")).distinct().toArrow()["bit"].to_numpy()
    bits[places] = 1
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard long, term binary, docs array<int>, times array<int>, sizes array<int>, ids array<{kind}>, total long"
    indexed = kept(docs.select("doc_id", "text").mapInArrow(_index(np.packbits(bits).tobytes(), shard_docs), schema), "postings")

    shards = indexed.where("term is null")
    n_docs, n_terms = shards.agg(F.sum(F.size("ids")), F.sum("total")).first()
    n_docs, n_terms = n_docs or 0, n_terms or 1
    postings = indexed.where("term is not null").select("shard", "term", "docs", "times", "sizes")
    found = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("times")).cast("long").alias("most"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    owner = sum((F.col("df") > share * n_docs).cast("int") for share in OWNERS)
    # With m at least 25, a posting adds at most this much of the weight.
    bound = F.floor(1_000_000_000 * F.col("most") / (1000 * F.col("most") + 200)) + 1
    weighed = (
        terms.join(found, "term")
        .withColumn("add", F.floor(1000 * F.log(ratio)).cast("long") * F.col("times"))
        .where("add > 0")
        .select("item", "block", "term", "add", owner.alias("owner"), (F.col("add") * bound).cast("long").alias("most"))
    )
    weighed = kept(weighed, "weights")
    n_owners = len(OWNERS) + 1
    left = [F.sum(F.when(F.col("owner") > s, F.col("most")).otherwise(0)) for s in range(n_owners)]
    rests = weighed.groupBy("block", "item").agg(F.array(*left).alias("rest"))
    asked = weighed.groupBy("block", "term", "owner").agg(F.collect_list(F.struct("item", "add")).alias("items"))
    due = kept(postings.join(kept(asked, "asked"), "term").select("block", "shard", "owner", "items", "docs", "times", "sizes"), "due")

    empty = [F.array().cast("array<int>").alias("docs"), F.array().cast("array<long>").alias("sums")]
    bundles = due.select("block", "shard").distinct().join(rests, "block").select("block", "shard", "item", "rest", *empty)
    carried = "block long, shard long, item long, rest array<long>, docs array<int>, sums array<long>"
    for s in range(n_owners):
        own = due.where(F.col("owner") == s).drop("owner").toDF("at", "of", "items", "docs", "times", "sizes")
        both = bundles.groupBy("block", "shard").cogroup(own.groupBy("at", "of"))
        bundles = both.applyInArrow(_stage(s, top, n_docs, n_terms), carried)

    sums = bundles.select("shard", "item", F.explode(F.arrays_zip("docs", "sums")).alias("x"))
    sums = sums.select("shard", "item", F.col("x.docs").alias("place"), F.col("x.sums").alias("score"))
    names = shards.select("shard", F.posexplode("ids").alias("place", "doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "shard", "place")
    best = sums.join(names, ["shard", "place"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
