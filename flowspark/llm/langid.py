"""Language identification by nearest centroids of TF-IDF character n-grams, with rejection by distance."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import in_fold, keep_rows, kept, slices

# n-grams of 1 to 3 characters are hashed into so many dimensions (a power of two).
DIMENSIONS = 4096
# So many documents of each language are learned from, however many languages there are; all if there are fewer.
SAMPLE = 1_000
CENTROIDS = 4
# So many values of `lang` are learned, those with most labelled documents: a bound on the model's size, 128 KB each.
MOST_LANGUAGES = 2_000
# This share of the sampled texts of a language may be odd: fewer alike make no centroid, and limits are taken above them.
ODD = 0.005
# A text is rejected if its cosine is below this share of what all but the odd texts of its language and length have.
NEAR = 0.9
# Where a length has fewer sampled texts, the beginnings of longer ones stand in for it, then shorter ones, which lie farther.
# A language of fewer texts in all is held to the share FAR.
LEAST_TEXTS = 20
FAR = 0.5
# Length classes of which beginnings are taken: the fewest letters of each, and how many of these are odd, more than of whole texts.
BEGINNINGS = {0: (1, 0.0), 1: (4, 0.0), 2: (16, 0.01), 3: (64, 0.05), 4: (256, 0.05)}
_LONGEST_BEGINNING = max(size for size, _ in BEGINNINGS.values())
UNDETERMINED = "und"

# What isn't a letter, or a mark on one. Without marks and such numbers, which are rare, the plain pattern finds the same, faster.
_NOT_LETTERS = regex.compile(r"(?:[^\p{L}\p{M}]|(?<![\p{L}\p{M}])\p{M}+)+")
_MARKS_AND_NUMBERS = regex.compile(r"[\p{M}\p{Nl}\p{No}]")
_PLAIN_NOT_LETTERS = re.compile(r"[\W\d_]+")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def letters_of(text: str | None) -> str:
    """Lower-cased letters with their marks, with one space for everything between them; empty without a letter."""
    lowered = (text or "").lower()
    found = "" if _MARKS_AND_NUMBERS.search(lowered) else _PLAIN_NOT_LETTERS.sub(" ", lowered).strip()
    # The plain pattern knows fewer scripts: where it finds nothing, the other one decides.
    return found or _NOT_LETTERS.sub(" ", lowered).strip()


def gram_counts(letters: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the letters, a space before and after."""
    c = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(DIMENSIONS)
    h = np.zeros(len(c), np.uint64)
    for n in range(1, 4):
        h = h[: len(c) - n + 1] * _FACTORS[n - 1] + c[n - 1 :] * _FACTORS[0] + np.uint64(n)
        at = (h ^ (h >> np.uint64(29))) * _FACTORS[1] >> np.uint64(16) & np.uint64(DIMENSIONS - 1)
        total += np.bincount(at.astype(np.int64), minlength=DIMENSIONS)
    return total


def length_class(letters: str) -> int:
    """Texts are compared in distance with texts of about their length: powers of four, at most 4^8."""
    return min(8, int(np.log2(max(1, len(letters))) / 2))


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    vectors: np.ndarray  # unit length, CENTROIDS of a language after those of another
    owner: np.ndarray  # index of the language
    least: np.ndarray  # by language and length class: a nearer cosine is needed not to be rejected

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the cosine with its nearest centroid, and whether that is too far off."""
        letters = letters_of(text)
        if not letters or not self.languages:
            return UNDETERMINED, 0.0, True
        near = self.vectors @ unit(gram_counts(letters) * self.idf)
        best = int(near.argmax())
        language = self.owner[best]
        cosine = float(min(1.0, max(0.0, near[best])))
        return self.languages[language], cosine, bool(cosine < self.least[language, length_class(letters)])


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def _means(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, and the cluster of each row; starts from vectors that are far from one another."""
    chosen = [int((x @ unit(x.mean(axis=0))).argmax())]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centers = x[chosen]
    for _ in range(12):
        of = (x @ centers.T).argmax(axis=1)
        centers = unit(np.stack([x[of == i].mean(axis=0) if (of == i).any() else centers[i] for i in range(len(centers))]))
    return centers, (x @ centers.T).argmax(axis=1)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids, none of them of odd texts alone: those are left out and the others clustered anew."""
    least = ODD * len(x)
    for _ in range(20):
        centers, of = _means(x, k)
        odd = np.bincount(of, minlength=len(centers)) < least
        if not odd[of].any() or odd.all():
            break
        x = x[~odd[of]]
    return centers


def _limits(near: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The least cosine not to be rejected, by length class, from the cosines and classes of the sampled texts of a language."""
    limits = np.zeros(9)
    for c in range(9):
        pools = (near[(shortest <= lengths) & (lengths <= c)] for shortest in range(c, -1, -1))
        pool, share = next(((p, NEAR) for p in pools if len(p) >= LEAST_TEXTS), (near, FAR))
        limits[c] = share * np.quantile(pool, ODD, method="lower")
    return limits


def _distances(x: np.ndarray, own: np.ndarray, lengths: np.ndarray, beginnings: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cosines of sampled texts with the nearest of their centroids, and their length classes; with beginnings where needed."""
    near, classes = [(x @ own.T).max(axis=1)], [lengths]
    for c, (size, odd) in BEGINNINGS.items():
        if (lengths == c).sum() < LEAST_TEXTS:
            cut = [t[:size] for t, length in zip(beginnings, lengths) if length > c]
            at = np.sort([(own @ unit(gram_counts(t.strip()) * idf)).max() for t in cut])[int(odd * len(cut)) :]
            near.append(at)
            classes.append(np.full(len(at), c))
    return np.concatenate(near), np.concatenate(classes)


def learn(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Centroids:
    """Fit on documents with a language whose crc32(id as text) mod 3 is not 1.

    Of each language the `sample` documents with the smallest hash of id and text are taken (all if there are fewer);
    their whole texts give the document frequencies, `k` centroids a language, and how near a text of a language lies to
    its centroids, by length; see `NEAR` for what is rejected. Texts without a letter, null
    languages and null ids teach nothing; documents under the name `und` do not either. Of more than `MOST_LANGUAGES` values
    those with most documents are learned.

    Languages are clustered each on an executor; the driver holds centroids only, at most `k` vectors a language.
    """
    train = docs.where("doc_id is not null and lang is not null and text is not null").where(~in_fold(3, 1))
    train = train.where(F.col("lang") != UNDETERMINED).where(F.col("text").rlike(r"\p{L}"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            letters = [letters_of(t) for t in batch.column("text").to_pylist()]
            counts = [gram_counts(x).astype(np.float32).tobytes() if x else None for x in letters]
            columns = [batch.column("lang"), batch.column("hash"), pa.array([length_class(x) for x in letters], pa.int32())]
            columns += [pa.array(counts, pa.binary()), pa.array([x[:_LONGEST_BEGINNING] for x in letters], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "hash", "length", "counts", "beginning"])

    # Twice as many as wanted are drawn, so that far fewer than all rows meet in the ranking of a language and enough are left.
    hashed = train.select("lang", "text", F.xxhash64("doc_id", "text").alias("hash"))
    drawn = F.shiftrightunsigned("hash", 11) / float(1 << 53)
    wanted = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    wanted = wanted.select("lang", (F.lit(2.0 * sample + 100) / F.col("count")).alias("wanted"))
    ranked = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("hash", 11), "hash", "length", "beginning")
    rows = kept(
        hashed.join(F.broadcast(wanted), "lang")
        .where(drawn < F.col("wanted"))
        .select("lang", "hash", "text")
        .mapInArrow(vectors, "lang string, hash long, length int, counts binary, beginning string")
        .where("counts is not null")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= sample)
        .drop("rank"),
        "language-sample",
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, having = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                having += np.frombuffer(counts, np.float32) > 0
                texts += 1
        at = [-1, *range(DIMENSIONS)]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([texts, *having], pa.int64())], ["at", "n"])

    summed = rows.select("counts").mapInArrow(frequencies, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    n = {r["at"]: r["n"] for r in summed.collect()}
    if not n.get(-1):
        return Centroids([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, np.int64), np.zeros((0, 9)))
    idf = np.log((1 + n[-1]) / (1 + np.array([n[i] for i in range(DIMENSIONS)]))) + 1

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hash", "ascending"), ("length", "ascending"), ("beginning", "ascending")])
        x = np.stack([np.frombuffer(c, np.float32) for c in table.column("counts").to_pylist()])
        x = unit(x * idf.astype(np.float32))
        own = _cluster(x, k)
        lengths = table.column("length").to_numpy()
        limits = _limits(*_distances(x, own, lengths, table.column("beginning").to_pylist(), idf))
        columns = [[table.column("lang")[0].as_py()], [own.astype(np.float32).tobytes()], [limits.tolist()]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.list_(pa.float64())))], ["lang", "centers", "least"])

    found = rows.groupBy("lang").applyInArrow(fitted, "lang string, centers binary, least array<double>").collect()
    found.sort(key=lambda r: r["lang"])
    centers = [np.frombuffer(r["centers"], np.float32).reshape(-1, DIMENSIONS) for r in found]
    owner = np.repeat(np.arange(len(found)), [len(c) for c in centers])
    return Centroids([r["lang"] for r in found], idf, np.concatenate(centers).astype(np.float64), owner, np.array([r["least"] for r in found]))


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """The language of every whole text, in one narrow pass.

    Returns doc_id, held_out, lang_pred, score (the cosine, 0 to 1), rejected, one row for each row of `docs`, also for null
    or repeated ids. A text that is null or has no letter is `und`, with score 0, and rejected; another always has one of the
    learned languages and is rejected if it lies farther off than texts of it and of about its length; short texts are held against beginnings. A null id is not held out. Ties go to the
    language that sorts first. Other columns are not read. An empty table gives no rows; without anything to learn from all
    are `und`.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in slices(batches):
            found = [own.predict(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "rejected"])

    found = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", in_fold(3, 1).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows, with all their columns, whose language is not rejected.

    A null or empty text, and any without a letter, goes; repeated rows fare alike; other columns, of whatever names, pass
    through. With a model that learned nothing all go; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def decider():
        own = sent.value
        return lambda texts: [not own.predict(t)[2] for t in texts]

    return keep_rows(docs, decider)
