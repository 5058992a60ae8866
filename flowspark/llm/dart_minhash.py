"""Near-duplicates by DartMinHash: hashed darts thrown into weighted element regions, the earliest kept per coordinate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import WORD_TABLE, Scratch, forget, slices
from flowspark.llm.graph import components
from flowspark.llm.hashing import as_signed, mix, odd, salt, word_hashes

WIDTH = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 meets in none of 24 bands of 4 coordinates with a chance of 3e-6.
BANDS = 24
ROWS = 4
# Members that are compared with one copy of a centre's elements.
SALTED = 256
# Texts of a block, about, and prefixes so short that they travel with each of their elements.
OPEN_BLOCK = 256
SHORT_PREFIX = 128

_SPACE = np.arange(256) == 32


def shingles(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed runs of `width` words and how often each occurs; a shorter text is one run, one without words none."""
    h, _ = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE), _SPACE)
    if not len(h):
        return h, np.zeros(0, np.int64)
    n = min(width, len(h))
    runs = np.full(len(h) - n + 1, salt(n))
    for j, factor in enumerate(odd(n)):
        runs += h[j : len(h) - n + 1 + j] * factor
    return np.unique(mix(runs), return_counts=True)


def cells(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each occurrence: the Jaccard similarity of these sets is the weighted one of the elements."""
    which = np.repeat(elements, counts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(which + mix(nth.astype(np.uint64))))


def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Identity and rank of every dart that hits an element's region, weight by rank up to `limit`.

    A region is cut into strips of weight 1, the last one narrower. Each strip's darts follow from hashes of element and
    strip alone: ranks with exponential gaps, places across the strip. So the darts of a smaller region are among those
    of a larger one of the same element, whatever the document.
    """
    strips = np.ceil(weights).astype(np.int64)
    which = np.repeat(elements, strips)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    seed = mix(which + mix(nth.astype(np.uint64)))
    wide = np.repeat(weights, strips) - nth
    rank = np.zeros(len(seed))
    ids, ranks = [], []
    turn = 0
    while len(seed):
        block = 1 if limit < 1 else int(limit + 6 * limit**0.5) + 8
        salts = np.array([salt(turn + i) for i in range(block)], np.uint64)
        hashed = mix(seed[:, None] ^ salts)
        at = rank[:, None] + np.cumsum(-np.log(_unit(hashed)), axis=1)
        hit = (at <= limit) & (_unit(mix(hashed + salt(-7))) <= wide[:, None])
        ids.append(mix(hashed + salt(-5))[hit])
        ranks.append(at[hit])
        rank = at[:, -1]
        alive = rank <= limit
        seed, wide, rank = seed[alive], wide[alive], rank[alive]
        turn += block
    return np.concatenate(ids), np.concatenate(ranks)


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of k coordinates. Two signatures agree in a coordinate with the chance of the weighted Jaccard similarity.

    About k ln k + 2k darts are thrown; if a coordinate stays empty, twice as many.
    """
    limit = (k * np.log(k) + 2 * k) / weights.sum()
    while True:
        ids, ranks = darts(elements, weights, limit)
        late_first = np.argsort(-ranks, kind="stable")
        ids = ids[late_first]
        chosen = np.zeros(k, np.uint64)
        filled = np.zeros(k, bool)
        at = (ids % np.uint64(k)).astype(np.int64)
        chosen[at] = ids
        filled[at] = True
        if filled.all():
            return chosen
        limit *= 2


def band_keys(text: str | None, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash for each band of the signature; none for a text without words."""
    elements, counts = shingles(text, width)
    if not len(elements):
        return np.zeros(0, np.int64)
    of = signature(elements, counts.astype(np.float64), bands * rows).reshape(bands, rows)
    return as_signed(mix((of * odd(rows)).sum(axis=1) + np.array([salt(i) for i in range(bands)], np.uint64)))


def text_node(text: str = "text") -> Column:
    """Digest that stands for a text and its exact copies; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _per_text(name: str, of):
    """Adds an array of longs to each different node of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            firsts = dict(reversed(list(zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()))))
            values = pa.array([of(t) for t in firsts.values()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(firsts), pa.binary()), values], ["node", name])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    """Every different text once: copies fold before the shuffle."""
    return docs.select(text_node().alias("node"), "text").groupBy("node").agg(F.any_value("text").alias("text"))


def _similarities(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """The weighted Jaccard similarity of each pair (a, b). Where many pairs share a b, its elements are copied for every 256.

    Both joins carry elements, so they are shuffled at every size; a table of elements is never broadcast.
    """
    copies = F.ceil(F.count("*") / SALTED).cast("int").alias("copies")
    spread = pairs.join(pairs.groupBy("b").agg(copies), "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).alias("copy"))
    a_side = spread.join(of.select(F.col("node").alias("a"), F.col("cells").alias("a_cells")).hint("merge"), "a")
    b_side = spread.select("b", "copy").distinct()
    b_side = b_side.join(of.select(F.col("node").alias("b"), F.col("cells").alias("b_cells")).hint("merge"), "b")
    shared = F.size(F.array_intersect("a_cells", "b_cells"))
    return a_side.join(b_side.hint("merge"), ["b", "copy"]).select(
        "a", "b", (shared / (F.size("a_cells") + F.size("b_cells") - shared)).alias("similarity")
    )


def _open_texts(members: DataFrame, elements: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Texts that may still be linked to another component: node, label, n (elements), `shared` (those of its elements that
    other components have, too, rarest first) and `prefix`, the first of these.

    `members` has the labels of the members of each bucket; only texts of buckets with several labels can still be linked.
    They are joined by prefix filtering, which is exact. Elements that only one component has cannot be shared across
    components. A pair of n and m elements is linked if it has at least (n + m) similarity / (1 + similarity) in common, so
    if each text's other elements are ordered by how many texts have them, a linked pair meets already among the few
    rarest that a text could spare.
    """
    bounds = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = members.join(bounds.where("lo <> hi").select("key"), "key", "left_semi")
    sized = scratch.kept(mixed.join(elements.select("node", F.size("cells").alias("n")), "node"), "mixed")
    shortest = sized.groupBy("key").agg(F.min("n").alias("shortest"))
    texts = sized.join(shortest, "key").groupBy("node", "label", "n").agg(F.min("shortest").alias("shortest"))
    share = similarity / (1 + similarity)
    least = F.greatest(F.ceil(F.col("n") * similarity - 1e-9), "shortest")
    needed = F.ceil((F.col("n") + least) * share - 1e-9).cast("int")
    texts = texts.select("node", "label", F.xxhash64("label").alias("of"), "n", needed.alias("needed"))

    parts = elements.join(texts, "node").select("node", "of", F.explode("cells").alias("cell"))
    common = parts.groupBy("cell").agg(F.count("*").alias("texts"), F.min("of").alias("lo"), F.max("of").alias("hi"))
    common = common.where("lo <> hi").select("cell", "texts")
    rarest = F.sort_array(F.collect_list(F.struct("texts", "cell")))
    shared = parts.join(common, "cell").groupBy("node").agg(rarest.alias("shared"))
    spare = F.size("shared") - F.col("needed") + 1
    cut = texts.join(shared, "node").where(spare > 0)
    prefix = F.slice("shared", 1, F.greatest(spare, F.lit(0)))["cell"].alias("prefix")
    return cut.select("node", "label", "n", F.col("shared.cell").alias("shared"), prefix)


def _open_links(members: DataFrame, elements: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Links between different components, at least one for each two that are linked at all: columns a, b.

    Open texts are put together in blocks of about `OPEN_BLOCK` of one component. Blocks are joined by prefix filtering, and two
    of them are left only if their texts have so many elements together that some pair of their sizes could be linked. For
    blocks of one text that is the answer. Of the texts of larger ones those are left that have enough elements of the
    other block; texts that have the same of these are alike to it but for their length, so the shortest stands for all.
    Representatives are joined by prefix filtering once more and compared by these elements, which is exact. So groups of
    near copies that share parts cost a comparison of blocks, not of all their texts.
    """
    share = similarity / (1 + similarity)
    texts = _open_texts(members, elements, similarity, scratch)
    parts = texts.groupBy("label").agg(F.ceil(F.count("*") / OPEN_BLOCK).cast("int").alias("parts"))
    block = F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("parts")))
    texts = scratch.kept(texts.join(parts, "label").withColumn("block", block).drop("parts"), "open-texts")
    all_of = lambda column: F.array_distinct(F.flatten(F.collect_list(column)))
    of_block = texts.groupBy("label", "block").agg(
        F.min("n").alias("lo"),
        F.max("n").alias("hi"),
        F.max(F.size("shared")).alias("most"),
        F.count("*").alias("texts"),
        all_of("shared").alias("cells"),
        all_of("prefix").alias("prefix"),
        F.min("node").alias("node"),
    )
    of_block = scratch.kept(of_block, "open-blocks")

    def side(df: DataFrame, end: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}_{end}" for c in df.columns if c != "cell"})

    # Where both lists are short, a pair is met at the least element that both have only.
    short = F.when(F.size("prefix") <= SHORT_PREFIX, F.col("prefix")).alias("short")
    starts = of_block.select("block", "label", "lo", "hi", "most", "texts", short, F.explode("prefix").alias("cell"))
    fitting = (F.col("hi_a") >= F.col("lo_b") * similarity - 1e-9) & (F.col("hi_b") >= F.col("lo_a") * similarity - 1e-9)
    least = (F.col("lo_a") + F.col("lo_b")) * share - 1e-9
    once = F.coalesce(F.array_min(F.array_intersect("short_a", "short_b")) == F.col("cell"), F.lit(True))
    met = side(starts, "a").join(side(starts, "b"), "cell").where(
        (F.col("block_a") < F.col("block_b"))
        & (F.col("label_a") != F.col("label_b"))
        & fitting
        & (F.least("most_a", "most_b") >= least)
        & once
    )
    pairs = scratch.kept(met.select("block_a", "block_b", "lo_a", "lo_b", "texts_a", "texts_b").distinct(), "open-pairs")
    cells = of_block.select("block", "cells", "node")
    both = pairs.join(side(cells, "a").hint("merge"), "block_a").join(side(cells, "b").hint("merge"), "block_b")
    close = both.where(F.size(F.array_intersect("cells_a", "cells_b")) >= least).drop("cells_a", "cells_b")
    close = scratch.kept(close, "open-close")
    single = (F.col("texts_a") == 1) & (F.col("texts_b") == 1)
    sure = close.where(single).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    one = close.where(~single).select(F.col("block_a").alias("block"), F.col("block_b").alias("other"), F.col("lo_b").alias("least"))
    two = close.where(~single).select(F.col("block_b").alias("block"), F.col("block_a").alias("other"), F.col("lo_a").alias("least"))
    others = of_block.select(F.col("block").alias("other"), "cells")
    near = texts.select("block", "node", "n", "shared").join(one.unionByName(two), "block").join(others.hint("merge"), "other")
    needed = F.ceil((F.col("n") + F.col("least")) * share - 1e-9).cast("int")
    near = near.select("block", "other", "node", "n", F.array_intersect("shared", "cells").alias("theirs"), needed.alias("needed"))
    shortest = (
        near.withColumn("spare", F.size("theirs") - F.col("needed") + 1)
        .where("spare > 0")
        .groupBy("block", "other", "theirs")
        .agg(F.min(F.struct("n", "node")).alias("best"), F.max("spare").alias("spare"))
        .select("block", "other", "theirs", "best.n", "best.node", F.explode(F.slice("theirs", 1, F.col("spare"))).alias("cell"))
    )
    shortest = scratch.kept(shortest, "open-shortest")
    a = shortest.where("block < other").toDF("block_a", "block_b", "theirs_a", "n_a", "a", "cell")
    b = shortest.where("block > other").toDF("block_b", "block_a", "theirs_b", "n_b", "b", "cell")
    together = F.size(F.array_intersect("theirs_a", "theirs_b"))
    linked = together / (F.col("n_a") + F.col("n_b") - together) >= similarity
    found = a.join(b, ["block_a", "block_b", "cell"]).where(linked).groupBy("block_a", "block_b").agg(F.min(F.struct("a", "b")).alias("link"))
    return sure.unionByName(found.select("link.a", "link.b"))


def near_links(
    docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Components of different texts that are linked: columns node, label (the least node of the component).

    Texts that agree in a band are candidates. In every bucket all members are compared with its centre, the one that meets
    most texts over all its buckets, so a large group of near copies costs about one comparison a member. Texts whose
    buckets then still hold different components are compared exactly, see `_open_links`, so no two components whose
    texts are linked stay apart. Similarities are exact, over all shingles.
    """
    scratch = Scratch()
    signed = docs.select(text_node().alias("node"), "text").mapInArrow(
        _per_text("keys", lambda t: band_keys(t, width, bands, rows)), "node binary, keys array<long>"
    )
    signed = scratch.kept(signed.groupBy("node").agg(F.any_value("keys").alias("keys")), "signatures")
    entries = signed.select("node", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.kept(entries.join(shared.hint("merge"), "key"), "members")
    met = members.join(members.groupBy("node").agg(F.sum("n").alias("met")), "node")
    centres = met.groupBy("key").agg(F.max(F.struct("met", "node")).alias("best")).select("key", F.col("best.node").alias("centre"))
    led = scratch.kept(members.join(centres, "key").select("key", "node", "centre"), "led")
    pairs = scratch.kept(led.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    wanted = members.select("node").distinct()
    elements = _texts(docs).join(wanted, "node", "left_semi").mapInArrow(
        _per_text("cells", lambda t: as_signed(cells(*shingles(t, width)))), "node binary, cells array<long>"
    )
    elements = scratch.kept(elements, "elements")
    known = scratch.kept(_similarities(pairs, elements), "similarities")
    links = known.where(F.col("similarity") >= similarity)
    found = components(links)
    labelled = led.join(found, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    late = scratch.kept(_open_links(labelled, elements, similarity, scratch), "late-links")
    if not late.isEmpty():
        found = components(links.select("a", "b").unionByName(late))
    scratch.clear()
    return found


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """The class of near-duplicates of every row of `docs`, over its whole text.

    Words are as for `words_of`; a text's elements are its runs of `width` words, weighted by how often they occur; two
    texts are linked from a weighted Jaccard similarity of `similarity` on; classes are connected components of links and
    exact copies. A shorter text is one run. Null and empty texts are copies of each other; a text without words is
    linked with exact copies only.

    Returns doc_id, class_id (the least doc_id of the class; null if all are), class_size (rows), class_texts (different
    texts), one row for each row of `docs`, also for null or repeated ids. Other columns are not read. An empty table gives
    no rows.
    """
    nodes = docs.select("doc_id", text_node().alias("node"))
    labels = near_links(docs, similarity, width)
    per_text = nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    per_text = per_text.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = per_text.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"), F.count("*").alias("class_texts")
    )
    of_text = per_text.select("node", "label").join(classes, "label").drop("label")
    return nodes.join(of_text, "node").select("doc_id", "class_id", "class_size", "class_texts")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """One row of each class, with all columns of `docs`: that with the least doc_id, null ids last, ties by the text's digest.

    Of rows with the same text and id one stays. Null and empty texts are one class. Columns go through by position, so their
    names may be anything. An empty table stays empty.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = (f"c{names.index(c)}" for c in ("text", "doc_id"))
    order = F.struct(F.col(doc_id).isNull().alias("absent"), F.col(doc_id).alias("id"))
    packed = plain.select(text_node(text).alias("node"), order.alias("order"), F.struct(*plain.columns).alias("row"))
    per_text = packed.groupBy("node").agg(F.min_by("row", "order").alias("row"))
    labels = near_links(docs.select("text"), similarity, width)
    ids = packed.groupBy("node").agg(F.min("order").alias("first"))
    best = labels.join(ids, "node").groupBy("label").agg(F.min_by("node", F.struct("first", "node")).alias("node"))
    gone = labels.select("node").join(best, "node", "left_anti")
    return per_text.join(gone, "node", "left_anti").select("row.*").toDF(*names)
