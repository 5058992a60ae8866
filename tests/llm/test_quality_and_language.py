import base64
import random
import string

import numpy as np
from conftest_llm import EDGES, MIDDLE, SMALL

from flowspark.llm import langid, quality
from flowspark.llm.boosting import fit
from flowspark.llm.common import kept as langid_kept


def test_flat_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = fit(x, y, trees=30)
    for row, score in zip(x[:100], forest.score(x[:100])):
        total = forest.prior
        for t in range(len(forest.leaf)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + (2 if row[forest.feature[t, node]] > forest.threshold[t, node] else 1)
            total += forest.leaf[t, node - forest.feature.shape[1]]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((forest.score(x) > 0.5) == y).mean() > 0.97


def test_forest_without_anything_to_learn():
    assert fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert fit(np.ones((4, 3)), np.ones(4)).score(np.ones((1, 3)))[0] > 0.5


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(docs, quality.learn(docs, labels))
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    y, score = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    assert auc(score, y) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    assert scored.count() == docs.count()


def test_quality_does_not_learn_from_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end quality")
    one, two = quality.learn(docs, labels), quality.learn(docs.selectExpr("doc_id", "text"), flipped)
    assert (one.leaf == two.leaf).all() and (one.feature == two.feature).all()


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, None, 1), (None, 1, 1), (6, 0, 1), (7, 1, 1), (7, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs(EDGES), labels)
    rows = quality.score_quality(docs(EDGES), model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    kept = quality.keep_quality(docs(EDGES), model)
    assert kept.columns == docs([]).columns
    assert kept.count() == sum(r["predicted"] for r in rows)
    assert quality.score_quality(docs([]), quality.learn(docs([]), labels.limit(0))).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = langid.identify(docs, langid.learn(docs))
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert found.count() == docs.count() and found.where("rejected").count() < 0.01 * docs.count()


def test_language_equals_plain_cosines(spark):
    """The nearest centroid, from n-gram counts made one by one."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").limit(400)
    model = langid.learn(docs)
    for r in docs.limit(30).collect():
        text = f" {langid.letters_of(r['text'])} "
        grams = langid.gram_counts(text.strip())
        assert grams.sum() == sum(len(text) - n + 1 for n in (1, 2, 3))
        v = grams * model.idf
        cosines = [float(c @ v / np.linalg.norm(v) / np.linalg.norm(c)) for c in model.vectors]
        language, score, _ = model.predict(r["text"])
        assert language == model.languages[model.owner[int(np.argmax(cosines))]] and abs(score - max(cosines)) < 1e-6


def test_language_of_odd_rows(spark, docs):
    rows = {}
    model = langid.learn(docs(EDGES))
    for r in langid.identify(docs(EDGES), model).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, rows.values())) == len(EDGES)
    for i in (2, 3, 4, 8):
        assert [(r["lang_pred"], r["score"], r["rejected"]) for r in rows[i]] == [("und", 0.0, True)]
    assert {r["lang_pred"] for i in (1, 6, 9) for r in rows[i]} == {"en"}
    nothing = langid.learn(docs([]))
    assert {r["lang_pred"] for r in langid.identify(docs(EDGES), nothing).collect()} == {"und"}
    assert langid.identify(docs([]), nothing).count() == 0
    kept = langid.keep_identified(docs(EDGES), model)
    assert kept.columns == docs([]).columns and 1 in {r["doc_id"] for r in kept.collect()}


def test_far_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = langid.learn(docs)
    assert model.predict("щжц ыюя хъэ ьжщ " * 30)[2] and not model.predict(docs.where("lang = 'de'").first()["text"])[2]


def test_junk_and_other_languages_in_latin_script_are_rejected(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = langid.learn(docs)
    rng = random.Random(5)
    words = [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 10))) for _ in range(n)) for n in (30, 100, 400)]
    coded = [base64.b64encode(rng.randbytes(n)).decode() for n in (300, 3000)] + [rng.randbytes(n).hex() for n in (300, 3000)]
    finnish = "Suomen kieli on suomalais-ugrilainen kieli, jota puhutaan pääasiassa Suomessa. Sitä puhuu äidinkielenään noin viisi miljoonaa ihmistä."
    polish = "Język polski należy do grupy języków zachodniosłowiańskich i jest językiem urzędowym w Polsce. Posługuje się nim wiele milionów ludzi."
    for text in [*words, *coded, finnish, finnish * 10, polish, polish * 10]:
        assert model.predict(text)[2], text[:60]
    held_out = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").collect()
    by_length = {}
    for r in held_out:
        if langid.letters_of(r["text"]):
            by_length.setdefault(len(r["text"]) > 500, []).append(model.predict(r["text"])[2])
    assert len(by_length) == 2 and all(np.mean(rejected) < 0.01 for rejected in by_length.values())


def test_limits_by_length():
    lengths = np.repeat([2, 3, 5, 6], [40, 5, 400, 3])
    near = np.concatenate([np.full(40, 0.6), np.full(5, 0.8), np.full(399, 0.95), [0.3], np.full(3, 0.99)])
    limits = langid._limits(near, lengths)
    assert np.allclose(limits[:8], [0.3, 0.3, 0.54, 0.54, 0.54, 0.855, 0.855, 0.855])
    assert np.allclose(langid._limits(np.array([0.8, 0.9]), np.array([4, 5])), 0.4)


def test_sample_is_of_each_language_and_no_language_is_dropped(spark, monkeypatch):
    """More languages than 1,000, most of few texts, beside a large one; those sampled are the ones with the smallest hashes."""
    rows = [(i, f"text number {i} of many", "en") for i in range(3000)] + [(10_000 + i, f"wörd{i} " * 5, f"l{i % 1100}") for i in range(4400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = []
    monkeypatch.setattr(langid, "kept", lambda df, name: taken.append(langid_kept(df, name)) or taken[-1])
    model = langid.learn(docs, sample=50)
    fold = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    assert model.languages == sorted(r["lang"] for r in fold.select("lang").distinct().collect()) and len(model.languages) > 1000
    hashes = {}
    for r in fold.selectExpr("lang", "xxhash64(doc_id, text) h").collect():
        hashes.setdefault(r["lang"], []).append(r["h"] % 2**64)
    sampled = {}
    for r in taken[0].collect():
        sampled.setdefault(r["lang"], []).append(r["hash"] % 2**64)
    assert {k: sorted(v) for k, v in sampled.items()} == {k: sorted(v)[:50] for k, v in hashes.items()}


def test_letters_are_letters_with_their_marks():
    assert langid.letters_of("½ ² ①② ٣ 5 _ Ⅷ") == ""
    assert langid.letters_of("हिन्दी, ABC1def") == "हिन्दी abc def"
    assert langid.letters_of("été ́ x") == "été x"
    assert langid.letters_of("́́") == langid.letters_of(None) == ""


def test_short_texts_are_held_against_beginnings(spark):
    """Letters of no learned language go, however few; short clean texts stay."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.learn(docs)
    for text in ("Ελληνικά", "qwrtpsdfghjklzxcvbnm", "中文中文", "½ ②"):
        assert model.predict(text)[2], text
    assert model.predict("½ ②")[:2] == ("und", 0.0)
    texts = [r["text"] for r in docs.collect() if r["lang"] and r["text"]]
    for size in (6, 12, 20, 40):
        cut = [t[:size] for t in texts if langid.letters_of(t[:size])]
        assert np.mean([model.predict(t)[2] for t in cut]) < 0.03, size


def test_the_number_of_languages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(i, f"text {i} {'abc'[i % 3]}" * 3, "de" if i % 12 == 0 else ("en", "fr")[i % 2]) for i in range(60)]
    assert langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["en", "fr"]
