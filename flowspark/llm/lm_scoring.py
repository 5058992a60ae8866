"""Language-model scoring by deleted interpolation: word and word-pair likelihoods mixed by how often the context was seen.

P(w | u) = l0 / (V + 1) + l1 c(w) / N + l2 c(u, w) / c(u), where the weights l belong to the bucket of c(u) and are learned by
expectation-maximisation on documents deleted from the counts. The final counts are those of all training documents.

Counts are exact (up to equal 64-bit hashes) and no table of them is ever broadcast. Documents are gathered into chunks of a few
megabytes. A chunk asks for each of its different words and pairs once; requests are shuffled by hash range, a reducer adds
the counts of all chunks and answers every one in the order it asked; then the chunk meets its answers and scores its texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import crc_of, kept, slices
from flowspark.llm.hashing import mix, odd, salt, word_hashes

CHUNK_BYTES = 5 << 20
# Text for which there is one range of hashes.
RANGE_BYTES = 8 << 20

KEPT, DELETED, UNSEEN = 0, 1, 2

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEPARATOR = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_END, _START = salt(-11), salt(-12)
# Context frequencies by powers of two; bucket 0 is for contexts never seen.
BUCKETS = 42
# Likelihood ratios are kept in steps of a quarter of an octave for learning the weights.
_STEPS = 4
_GRID = 1024


def part_of(doc_id: str = "doc_id"):
    """Unseen: crc32(id as text) mod 7 is 2. Deleted, for learning the weights: it is 3. Kept: all others and null ids."""
    fold = crc_of(doc_id) % 7
    return F.when(fold == 2, UNSEEN).when(fold == 3, DELETED).otherwise(KEPT)


class Tokens:
    """The tokens of a chunk's documents: words, then one end each. Words and pairs are numbered in the order of their hashes."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts).translate(_LOWER)
        words, starts = word_hashes(data, _SEPARATOR)
        del data
        ends = np.cumsum([len(t) + 1 for t in texts])
        until = np.searchsorted(starts, ends)
        token = np.insert(words, until, _END)
        self.document_ends = until + np.arange(1, len(texts) + 1)
        first = np.append(0, self.document_ends[:-1])
        before = np.roll(token, 1)
        before[first] = _START
        pair = mix(before * odd(2)[0] + token * odd(2)[1])
        self.document = np.repeat(np.arange(len(texts)), self.document_ends - first)
        # The number of documents is how often the start is a context: it is counted as a word, once a document.
        asked = np.append(token, np.full(len(texts), _START))
        self.words, at, self.word_counts = np.unique(asked, return_inverse=True, return_counts=True)
        self.token = at[: len(token)]
        self.before = np.roll(self.token, 1)
        self.before[first] = at[len(token) :]
        self.pairs, self.pair, self.pair_counts = np.unique(pair, return_inverse=True, return_counts=True)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences of the number of bytes that takes least; larger differences stand apart, with their places."""
    steps = np.diff(keys, prepend=np.uint64(0))
    sizes = {w: len(steps) * w + 12 * int((steps >> np.uint64(8 * w)).astype(bool).sum()) for w in range(1, 8)}
    sizes[8] = 8 * len(steps)
    width = min(sizes, key=sizes.get)
    far = np.flatnonzero(steps >> np.uint64(8 * width)) if width < 8 else np.zeros(0, np.int64)
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return bytes([width]) + len(far).to_bytes(4, "little") + far.astype("<u4").tobytes() + steps[far].astype("<u8").tobytes() + body


def unpack_keys(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:5], "little")
    raw = np.frombuffer(data, np.uint8, offset=5 + 12 * n).reshape(-1, width)
    steps = np.zeros((len(raw), 8), np.uint8)
    steps[:, :width] = raw
    steps = steps.view("<u8").ravel()
    steps[np.frombuffer(data, "<u4", n, 5)] = np.frombuffer(data, "<u8", n, 5 + 4 * n)
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    wide = len(counts) and counts.max() >= 2**32
    return (b"\x08" if wide else b"\x04") + zlib.compress(counts.astype("<u8" if wide else "<u4").tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), "<u8" if data[0] == 8 else "<u4").astype(np.int64)


def _chunks():
    """Rows (part, ids, sizes, blob): whole documents of one part, about CHUNK_BYTES of text."""
    names = ["part", "ids", "sizes", "blob"]

    def row(part: int, held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        blob = zstandard.ZstdCompressor(level=1).compress(b"".join(t for _, t in held))
        columns = [
            pa.array([part], pa.int32()),
            pa.array([[i for i, _ in held]], pa.list_(kind)),
            pa.array([[len(t) for _, t in held]], pa.list_(pa.int64())),
            pa.array([blob], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size: dict[int, int] = {}
        kind = None
        for batch in slices(batches):
            kind = batch.schema.field("doc_id").type
            for doc_id, part, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text"))):
                data = (text or "").encode("utf-8", "surrogatepass")
                held.setdefault(part, []).append((doc_id, data))
                size[part] = size.get(part, 0) + len(data) + 16
                if size[part] >= CHUNK_BYTES:
                    yield row(part, held.pop(part), kind)
                    size[part] = 0
        for part in sorted(held):
            yield row(part, held[part], kind)

    return run


def _texts_of(blob: bytes, sizes: list[int]) -> list[bytes]:
    data, at, texts = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for n in sizes:
        texts.append(data[at : at + n])
        at += n
    return texts


def _requests(bits: int):
    """Rows (pairs, range, chunk, part, keys, counts): a chunk's different words or pairs of one range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pairs", "range", "chunk", "part", "keys", "counts"]
        types = [pa.bool_(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                tokens = Tokens(_texts_of(row["blob"], row["sizes"]))
                rows = []
                for pairs, keys, counts in ((False, tokens.words, tokens.word_counts), (True, tokens.pairs, tokens.pair_counts)):
                    of = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(of, prepend=-1))
                    for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
                        rows.append((pairs, of[a], row["chunk"], row["part"], pack_keys(keys[a:b]), pack_counts(counts[a:b])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


ANSWER = "pairs boolean, range int, chunk long, part int, kept binary, deleted binary, tokens long, types long, kept_tokens long, kept_types long"
_ANSWER = pa.schema(
    [("pairs", pa.bool_()), ("range", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("kept", pa.binary()), ("deleted", pa.binary())]
    + [(c, pa.int64()) for c in ("tokens", "types", "kept_tokens", "kept_types")]
)


def _answer(requests: pa.Table) -> pa.Table:
    """Adds up one range of hashes and answers each request in its order; a row without a chunk has the range's totals."""
    rows = requests.to_pylist()
    keys = [unpack_keys(r["keys"]) for r in rows]
    different, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])
    total = {}
    for part in (KEPT, DELETED):
        counts = [unpack_counts(r["counts"]) if r["part"] == part else np.zeros(len(k), np.int64) for r, k in zip(rows, keys)]
        sums = np.zeros(len(different), np.int64)
        np.add.at(sums, at, np.concatenate(counts))
        total[part] = sums
    out = []
    for r, k, end in zip(rows, keys, ends):
        own = at[end - len(k) : end]
        answers = [pack_counts(total[part][own]) for part in (KEPT, DELETED)]
        out.append({"pairs": r["pairs"], "range": r["range"], "chunk": r["chunk"], "part": r["part"], "kept": answers[0], "deleted": answers[1]})
    if not rows[0]["pairs"]:
        words = different != _START
        kept_counts, both = total[KEPT][words], (total[KEPT] + total[DELETED])[words]
        totals = (both.sum(), (both > 0).sum(), kept_counts.sum(), (kept_counts > 0).sum())
        out.append({"pairs": False, "range": rows[0]["range"], **dict(zip(_ANSWER.names[6:], map(int, totals)))})
    return pa.Table.from_pylist(out, _ANSWER)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _answered(answers: pa.Table) -> dict[str, np.ndarray]:
    """A chunk's counts of words and pairs, kept and deleted, in the order it asked."""
    rows = sorted(answers.to_pylist(), key=lambda r: (r["pairs"], r["range"]))
    found = {}
    for pairs in (False, True):
        for part in ("kept", "deleted"):
            found[f"{'pair' if pairs else 'word'}_{part}"] = np.concatenate([unpack_counts(r[part]) for r in rows if r["pairs"] == pairs])
    return found


@dataclass
class Totals:
    """Of training documents, and of the kept part of them: tokens and different tokens."""

    tokens: int
    types: int
    kept_tokens: int
    kept_types: int


def _steps(ratio: np.ndarray) -> np.ndarray:
    """Quarter octaves of a likelihood ratio, 0 for a ratio of 0."""
    out = np.zeros(len(ratio), np.int64)
    some = ratio > 0
    out[some] = np.clip(np.rint(np.log2(ratio[some]) * _STEPS), -_GRID // 2 + 1, _GRID // 2 - 1) + _GRID // 2
    return out


def _events(totals: Totals):
    """For a chunk of deleted documents how often each cell occurs: bucket, ratio of the word's and of the pair's likelihood to
    the uniform one, all by kept counts. There are at most as many cells as the grid has, whatever the input."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        cells: np.ndarray = np.zeros(0, np.int64)
        for row in chunk.to_pylist():
            tokens, found = Tokens(_texts_of(row["blob"], row["sizes"])), _answered(answers)
            word, pair = found["word_kept"][tokens.token], found["pair_kept"][tokens.pair]
            context = found["word_kept"][tokens.before]
            uniform = 1 / (totals.kept_types + 1)
            one = word / max(totals.kept_tokens, 1) / uniform
            two = pair / np.maximum(context, 1) / uniform
            cells = np.append(cells, (_bucket(context) * _GRID + _steps(one)) * _GRID + _steps(two))
        cell, n = np.unique(cells, return_counts=True)
        return pa.table({"cell": pa.array(cell, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def learn_weights(cell: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights by bucket (uniform, word, pair) that make the deleted tokens likeliest, by expectation-maximisation.

    One imagined event for each weight keeps all of them above 0; a bucket without events takes the weights of the next
    lower one that has some. A context never seen has no pair weight.
    """
    bucket, one, two = cell // _GRID**2, cell // _GRID % _GRID, cell % _GRID
    ratio = np.stack([np.ones(len(cell))] + [np.where(x > 0, 2.0 ** ((x - _GRID // 2) / _STEPS), 0) for x in (one, two)], axis=1)
    may = np.ones((BUCKETS, 3))
    may[0, 2] = 0
    weights = may / may.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        share = weights[bucket] * ratio
        share *= (n / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, i], BUCKETS) for i in range(3)], axis=1) + may
        weights = sums / sums.sum(axis=1, keepdims=True)
    seen = np.bincount(bucket, n, BUCKETS) > 0
    for b in range(2, BUCKETS):
        if not seen[b] and seen[1:b].any():
            weights[b] = weights[b - 1]
    return weights


def token_scores(word, pair, context, totals: Totals, weights: np.ndarray) -> np.ndarray:
    """log10 P(w | u) of each token from its counts."""
    mixed = weights[_bucket(context)]
    p = mixed[:, 0] / (totals.types + 1) + mixed[:, 1] * word / max(totals.tokens, 1)
    p = p + mixed[:, 2] * pair / np.maximum(context, 1)
    return np.log10(p)


def _score(totals: Totals, weights: np.ndarray):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        kind = chunk.schema.field("ids").type.value_type
        for row in chunk.to_pylist():
            tokens, found = Tokens(_texts_of(row["blob"], row["sizes"])), _answered(answers)
            words, pairs = found["word_kept"] + found["word_deleted"], found["pair_kept"] + found["pair_deleted"]
            word, context = words[tokens.token], words[tokens.before]
            base = np.log10((word + 1) / (totals.tokens + 1 * (totals.types + 1)))
            score = token_scores(word, pairs[tokens.pair], context, totals, weights)
            n = len(row["ids"])
            columns = {
                "doc_id": pa.array(row["ids"], kind),
                "part": pa.array([row["part"]] * n, pa.int32()),
                "n_tokens": pa.array(np.bincount(tokens.document, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(tokens.document, word > 0, n).astype(np.int64), pa.int64()),
                "base_score": pa.array(np.bincount(tokens.document, base, n)),
                "score": pa.array(np.bincount(tokens.document, score, n)),
            }
            tables.append(pa.table(columns))
        if tables:
            return pa.concat_tables(tables)
        empty = {"doc_id": kind, "part": pa.int32(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.table({c: pa.array([], t) for c, t in empty.items()})

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """Score every row's whole text under a model of the rows whose crc32(id as text) mod 7 is not 2.

    Tokens are words between white space, A-Z lower-cased, then one end; a null text is empty and has its end alone.

    Returns doc_id, held_out (the remainder is 2), n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (add-one unigram), score (log10 probability under the model), one row for each row of `docs`, also for null (they are
    trained on) or repeated ids. Other columns are not read. An empty table gives no rows; without training documents the
    uniform likelihood decides.
    """
    name = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", part_of().cast("int").alias("part"), "text")
    chunks = rows.mapInArrow(_chunks(), f"part int, ids array<{name}>, sizes array<long>, blob binary")
    chunks = kept(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    size = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = max(4, (size // RANGE_BYTES).bit_length())
    requests = chunks.select("chunk", "part", "sizes", "blob").mapInArrow(
        _requests(bits), "pairs boolean, range int, chunk long, part int, keys binary, counts binary"
    )
    answers = kept(requests.groupBy("pairs", "range").applyInArrow(_answer, ANSWER), "answers")
    sums = answers.where("chunk is null").agg(*[F.sum(c) for c in _ANSWER.names[6:]]).first()
    totals = Totals(*[x or 0 for x in sums])
    replies = answers.where("chunk is not null").select("pairs", "range", "chunk", "part", "kept", "deleted")

    def meet(which, run, schema: str) -> DataFrame:
        left = chunks.where(which).groupBy("chunk")
        return left.cogroup(replies.where(which).groupBy("chunk")).applyInArrow(run, schema)

    events = meet(F.col("part") == DELETED, _events(totals), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = events.orderBy("cell").collect()
    weights = learn_weights(np.array([r["cell"] for r in seen], np.int64), np.array([r["n"] for r in seen], np.float64))
    scored = meet(
        F.lit(True),
        _score(totals, weights),
        f"doc_id {name}, part int, n_tokens long, n_known long, base_score double, score double",
    )
    held_out = (F.col("part") == UNSEEN).alias("held_out")
    train = F.lit(totals.tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", train, "base_score", "score")
