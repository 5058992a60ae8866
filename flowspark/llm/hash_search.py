"""Nearest neighbours by multi-index hashing: learned rotated binary codes in substring buckets, probed by the pigeonhole principle.

Each query widens its radius ring by ring and stops when so many codes lie within it as, on the sample, held the true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import Scratch

# Codes are cut into substrings of 64 bits: so long that few buckets are near a query even at a wide radius.
BITS = 256
# The most vectors of a dimension that its rotation and rings are learned from: those with the smallest hash.
SAMPLE = 4_096
# The share of true neighbours, among the sample, that lie within the ring at which a search stops.
WITHIN = 0.985
# So many of the most frequent dimensions have codes. Vectors of others, few as they are, are compared one by one.
CODED = 4
# Vectors of a shard of the index, and bytes of queries that are broadcast at once.
SHARD = 4_096
BLOCK_BYTES = 32 << 20


@dataclass
class Codes:
    """Binary codes of `bits` bits. Vectors are lengthened by one component so that all have the norm `longest`: the angle then
    orders candidates as the inner product does."""

    longest: float
    mean: np.ndarray
    rotation: np.ndarray  # components + 1 by bits
    enough: float  # share of all codes that is to lie within the last ring

    def of(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of 64-bit substrings. Queries are scaled to the common norm, their added component is 0."""
        norms = np.linalg.norm(x, axis=1)
        if query:
            x, added = x * (self.longest / np.maximum(norms, 1e-300))[:, None], np.zeros(len(x))
        else:
            added = np.sqrt(np.maximum(self.longest**2 - norms**2, 0))
        bits = (np.column_stack([x, added]) - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint64)


def learn(x: np.ndarray, longest: float, k: int, bits: int = BITS, within: float = WITHIN) -> Codes:
    """Rotate principal components so that signs lose least, several times from different starts until there are enough bits;
    then see how many codes lie no farther than the share `within` of the true k nearest among the sample."""
    added = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    full = np.column_stack([x, added])
    mean = full.mean(axis=0)
    centred = full - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    basis = vectors[:, ::-1]
    parts, missing, random = [], bits, np.random.default_rng(7)
    while missing:
        # The last direction has no spread when all norms are equal.
        size = min(missing, max(1, x.shape[1]))
        y = centred @ basis[:, :size]
        turn = np.linalg.qr(random.normal(size=(size, size)))[0]
        for _ in range(30):
            u, _, vt = np.linalg.svd(np.sign(y @ turn).T @ y)
            turn = (u @ vt).T
        parts.append(basis[:, :size] @ turn)
        missing -= size
    codes = Codes(longest, mean, np.concatenate(parts, axis=1), 1.0)
    asking = np.arange(min(len(x), 256))
    if len(x) > k + 1:
        products = x[asking] @ x.T
        products[asking, asking] = -np.inf
        nearest = np.argpartition(-products, k, axis=1)[:, :k]
        apart = np.bitwise_count(codes.of(x[asking], query=True)[:, None, :] ^ codes.of(x)).sum(axis=2)
        nearer = np.sort(apart, axis=1)
        ranks = [np.searchsorted(row, at, "right") for row, at in zip(nearer, np.take_along_axis(apart, nearest, axis=1))]
        codes.enough = float(np.quantile(np.array(ranks) / len(x), within))
    return codes


class Index:
    """The codes of one shard, bucketed by every substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.buckets = []
        for s in range(codes.shape[1]):
            values, which = np.unique(codes[:, s], return_inverse=True)
            self.buckets.append((values, which))

    def search(self, query: np.ndarray, enough: int) -> tuple[np.ndarray, int]:
        """Every row whose code lies within the first ring that holds `enough` of them, and how many rows were probed.

        Up to a radius of m (r + 1) - 1 for m substrings, a code has a substring that differs in at most r bits (else the sum
        would be larger). So ring r probes, for each substring, the occupied buckets at distance r, and then has seen
        every code within its radius; whole codes decide which these are.
        """
        m = len(self.buckets)
        # The ring in which a row is probed first: that of its nearest bucket.
        ring = np.min([np.bitwise_count(values ^ query[s])[which] for s, (values, which) in enumerate(self.buckets)], axis=0)
        order = np.argsort(ring, kind="stable")
        ends = np.cumsum(np.bincount(ring, minlength=1))
        apart = np.zeros(len(order), np.int64)
        done = 0
        for r, end in enumerate(ends):
            if end > done:
                apart[done:end] = np.bitwise_count(self.codes[order[done:end]] ^ query).sum(axis=1)
                done = end
            if done >= enough:
                inside = apart[:done] <= m * (r + 1) - 1
                if inside.sum() >= enough:
                    return order[:done][inside], done
        return order, len(order)


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


FOUND = pa.schema(
    [("query", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("probed", pa.int64())]
)


def _search(block: Broadcast, k: int):
    """The k best rows of a task's shards for each query of a block; `probed` counts rows whose code was looked at, on its first."""

    def shard(table: pa.Table, queries: dict, codes: Codes | None, best: dict) -> None:
        x, ids, rows = _matrix(table, "v"), table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        index = Index(codes.of(x)) if codes else None
        enough = min(len(x), max(k + 1, int(np.ceil(codes.enough * len(x))))) if codes else 0
        coded = codes.of(queries["v"], query=True) if codes else [None] * len(queries["row"])
        for own, vector, code in zip(queries["row"], queries["v"], coded):
            at, probed = index.search(code, enough) if index else (np.arange(len(x)), len(x))
            at = at[rows[at] != own]
            score = (x[at] * vector).sum(axis=1)
            old = best.get(own)
            if old:
                score, near, of = np.append(score, old[0]), np.append(ids[at], old[1]), np.append(rows[at], old[2])
            else:
                near, of = ids[at], rows[at]
            if len(score) > k:
                top = score >= np.partition(score, len(score) - k)[len(score) - k]
                score, near, of = score[top], near[top], of[top]
            first = np.lexsort((of, near, -score))[:k]
            best[own] = (score[first], near[first], of[first], probed + (old[3] if old else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, best = block.value, {}
        held: dict[int, list[pa.Table]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table.column("size").to_numpy()
            for size in np.unique(sizes):
                if int(size) not in blocks:
                    continue
                held.setdefault(int(size), []).append(table.filter(pa.array(sizes == size)))
                while sum(t.num_rows for t in held[int(size)]) >= SHARD:
                    whole = pa.concat_tables(held[int(size)])
                    held[int(size)] = [whole.slice(SHARD)]
                    shard(whole.slice(0, SHARD), *blocks[int(size)], best)
        for size, tables in held.items():
            whole = pa.concat_tables(tables)
            if whole.num_rows:
                shard(whole, *blocks[size], best)
        for own, (score, near, of, probed) in best.items():
            n = len(score)
            columns = [np.full(n, own), of, near, score, np.append(probed, np.zeros(max(0, n - 1), np.int64))[:n]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return run


def usable(vectors: DataFrame, is_query: Column) -> DataFrame:
    """vec_id, v (doubles), size and asked of what takes part: no null id, no null, empty or zero vector, all components finite.

    Rows that repeat both id and vector are one row; rows of one id with different vectors are rows of their own.
    """
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    asked = F.coalesce(is_query, F.lit(False)).alias("asked")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), asked)
    rows = rows.where("vec_id is not null and size(v) > 0").where(finite & F.exists("v", lambda c: c != 0))
    return rows.groupBy("vec_id", "v").agg(F.max("asked").alias("asked")).withColumn("size", F.size("v"))


def _learned(rows: DataFrame, k: int, sample: int, bits: int) -> dict[int, Codes]:
    """Codes of the most frequent dimensions."""
    most = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(CODED).collect()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    codes = {}
    for size in (r["size"] for r in most):
        of_size = rows.where(F.col("size") == size)
        longest = of_size.agg(F.max(norm)).first()[0]
        drawn = of_size.select("vec_id", "v").orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(sample).collect()
        codes[size] = learn(np.array([r["v"] for r in drawn], np.float64), longest, k, bits)
    return codes


def _blocks(queries: DataFrame, block_bytes: int) -> Iterator[dict[int, dict]]:
    """The queries by dimension, in blocks of about `block_bytes`: what is broadcast at once."""
    total = queries.agg(F.sum(F.col("size") * 8 + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        part = queries if n == 1 else queries.where(F.pmod(F.xxhash64("row"), F.lit(n)) == i)
        found: dict[int, dict] = {}
        for r in part.select("row", "size", "v").collect():
            of = found.setdefault(r["size"], {"row": [], "v": []})
            of["row"].append(r["row"])
            of["v"].append(r["v"])
        yield {size: {"row": np.array(q["row"], np.int64), "v": np.array(q["v"], np.float64)} for size, q in found.items()}


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, sample: int = SAMPLE, bits: int = BITS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """For each row that `is_query` selects its k nearest others by inner product: query_id, rank (from 1), vec_id, score, probed.

    A query is compared with vectors of its own dimension. Rotations and rings are learned on at most `sample` vectors of each of
    the `CODED` most frequent dimensions; every vector is indexed, where it is read, in shards that tasks make once for
    a block of queries. Blocks of about `block_bytes` are broadcast, one after the other; tasks return the k best of
    their rows. Scores are exact products of the original vectors in double precision; ties go to the smaller id. A ring
    holds more than k codes of a shard, so a query finds k others, or all there are. `probed` is the share of the rows
    of its dimension whose codes a query looked at.

    See `usable` for vectors that take no part. Without usable rows or queries there are no results. Columns other than
    vec_id and embedding are not read, unless `is_query` does.
    """
    spark, scratch = vectors.sparkSession, Scratch()
    rows = scratch.kept(usable(vectors, is_query).withColumn("row", F.monotonically_increasing_id()), "vectors")
    codes = _learned(rows, k, sample, bits)
    found = None
    for block in _blocks(rows.where("asked"), block_bytes):
        sent = spark.sparkContext.broadcast({size: (queries, codes.get(size)) for size, queries in block.items()})
        schema = "query long, row long, vec_id long, score double, probed long"
        part = scratch.kept(rows.select("row", "vec_id", "v", "size").mapInArrow(_search(sent, k), schema), "found")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    probed = found.groupBy("query").agg(F.sum("probed").alias("looked"))
    sizes = rows.groupBy("size").agg(F.count("*").alias("n"))
    asked = rows.where("asked").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "size")
    shares = asked.join(sizes, "size").join(probed, "query")
    shares = shares.select("query", "query_id", (F.col("looked") / F.col("n")).alias("probed"))
    return ranked.drop("probed").join(shares, "query").select("query_id", "rank", "vec_id", "score", "probed")
