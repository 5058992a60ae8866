import random
from collections import Counter

import numpy as np
from conftest_llm import EDGES, SMALL

from flowspark.llm import dart_minhash
from flowspark.llm.common import words_of
from flowspark.llm.dart_minhash import cells, keep_one, near_duplicates, shingles, signature
from flowspark.llm.graph import components
from flowspark.llm.hashing import word_hashes


def bag(text):
    words = words_of(text)
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes_by_brute_force(rows):
    """Least id and size of the class of each row: every pair of different texts is compared."""
    texts = sorted({t or "" for _, t in rows})
    of = {t: t for t in texts}

    def root(t):
        while of[t] != t:
            t = of[t]
        return t

    bags = [bag(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                of[root(texts[i])] = root(texts[j])
    groups = {}
    for doc_id, t in rows:
        groups.setdefault(root(t or ""), []).append((doc_id, t or ""))
    out = []
    for members in groups.values():
        least = min((i for i, _ in members if i is not None), default=None)
        out += [(i, least, len(members), len({t for _, t in members})) for i, _ in members]
    return sorted(out, key=repr)


def edited(words, rate, rng):
    return [rng.choice(["new", "other", "thing"]) + str(rng.random()) if rng.random() < rate else w for w in words]


def family(rng, n, length=120):
    """A text and edited copies, some of them beyond the threshold from it but near one another."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    return [" ".join(edited(words, rng.choice([0, 0.01, 0.02, 0.04, 0.08]), rng)) for _ in range(n)]


def test_word_hashes_do_not_depend_on_place_or_segment(monkeypatch):
    space = np.arange(256) == 32
    whole, starts = word_hashes(b" one two  one three", space)
    assert starts.tolist() == [1, 5, 10, 14] and whole[0] == whole[2] and len(set(whole.tolist())) == 3
    monkeypatch.setattr("flowspark.llm.hashing._SEGMENT", 3)
    again, at = word_hashes(b" one two  one three", space)
    assert again.tolist() == whole.tolist() and at.tolist() == starts.tolist()
    assert len(word_hashes(b"", space)[0]) == len(word_hashes(b"   ", space)[0]) == 0


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(5)
    for scale in (0.02, 1.0, 7.3):  # regions narrower and wider than a strip
        elements = rng.integers(1, 2**63, 300).astype(np.uint64)
        a, b = rng.random(300) * scale, rng.random(300) * scale
        a[:100], b[200:] = b[:100], 0
        some = b > 0
        expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        agree = (signature(elements, a, 2048) == signature(elements[some], b[some], 2048)).mean()
        assert abs(agree - expected) < 4 * (expected * (1 - expected) / 2048) ** 0.5


def test_cells_give_the_weighted_similarity():
    x, y = "a b c d e a b c d e a b c d e f", "a b c d e a b c d e g"
    p, q = cells(*shingles(x)), cells(*shingles(y))
    both = len(np.intersect1d(p, q))
    assert both / (len(p) + len(q) - both) == similarity(bag(x), bag(y))
    assert len(shingles("two words")[0]) == 1 and len(shingles("")[0]) == len(shingles(None)[0]) == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (5, 4)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["label"] for r in components(df).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components(df.limit(0)).count() == 0


def test_classes_equal_brute_force(docs):
    rng = random.Random(11)
    texts = [t for n in (40, 25, 3, 2, 1, 1) for t in family(rng, n)]
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(texts[:5])] + EDGES
    found = near_duplicates(docs(rows)).collect()
    expected = classes_by_brute_force(rows)
    assert sorted(map(tuple, found), key=repr) == expected
    assert len({e[1] for e in expected}) > 10


def test_given_documents_equal_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert sorted(map(tuple, near_duplicates(table).collect()), key=repr) == classes_by_brute_force(rows)


def test_one_of_each_class_is_kept(docs):
    rows = docs(EDGES + [(30, "One two three four five six")])
    kept = keep_one(rows)
    assert kept.columns == rows.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # 3 repeats the null text 2; the null row does too; 30 is 1 without a mark; a repeated row stays once.
    assert ids == sorted([1, 1, 2, 4, None, 5, 6, 7, 8, 9], key=repr)


def overlapping(n):
    """Three groups of near copies, each with half of its words from the group before and edits of their own."""
    rng = random.Random(3)
    parts = [[f"p{k}w{i}" for i in range(60)] for k in range(4)]
    return [" ".join(edited(parts[k] + parts[k + 1], 0.01, rng)) for k in range(3) for _ in range(n)]


def test_groups_that_share_parts_cost_no_pairs_of_their_texts(docs, monkeypatch):
    """What is left to compare beyond the centres grows no faster than the texts, and classes are right."""
    made = []

    def counted(*args):
        links = open_links(*args)
        scratch = args[-1]
        # Kept tables of the comparison: none may hold pairs of texts.
        made[-1] += sum(spark_of(path).count() for _, path in scratch._paths if "/open-" in path)
        return links

    open_links = dart_minhash._open_links
    spark_of = docs([]).sparkSession.read.parquet
    monkeypatch.setattr(dart_minhash, "_open_links", counted)
    for n in (20, 40):
        made.append(0)
        rows = list(enumerate(overlapping(n)))
        assert sorted(map(tuple, near_duplicates(docs(rows)).collect()), key=repr) == classes_by_brute_force(rows)
    assert made[1] <= 3 * max(made[0], 200)


def test_components_linked_only_beyond_their_centres(spark, monkeypatch):
    """Elements of two components whose only link is between texts that are no centres: it is found; without it there is none."""
    from flowspark.llm.common import Scratch

    core = list(range(100))
    a = {"a1": core[:90] + [1001], "a2": core[:88] + [1002, 1003, 1004]}
    for other, linked in ((core[:86] + [2001, 2002], True), (core[:40] + list(range(3000, 3048)), False)):
        b = {"b1": other, "b2": core[40:80] + list(range(4000, 4050))}
        elements = spark.createDataFrame([(k.encode(), v) for k, v in {**a, **b}.items()], "node binary, cells array<long>")
        members = spark.createDataFrame(
            [(key, n.encode(), n[0].encode()) for key, ns in ((1, ("a1", "b1")), (2, ("a2", "b2", "b1"))) for n in ns], "key long, node binary, label binary"
        )
        scratch = Scratch()
        found = dart_minhash._open_links(members, elements, 0.8, scratch).collect()
        pairs = {(x, y) for x in a for y in b if len({*a[x]} & {*b[y]}) / len({*a[x]} | {*b[y]}) >= 0.8}
        assert bool(pairs) == linked and len(found) == int(linked)
        assert not linked or tuple(bytes(x).decode() for x in found[0]) in pairs
        scratch.clear()


def test_empty_tables(docs):
    assert near_duplicates(docs([])).count() == 0 and keep_one(docs([])).count() == 0


def test_pairs_beyond_the_centre_are_compared(docs, monkeypatch):
    """A chain a - b - c whose ends are too far apart: whatever the centre, the class is whole."""
    words = [f"w{i}" for i in range(104)]
    chain = [" ".join(words)]
    for k in (10, 50, 90):
        words[k] = f"x{k}"
        chain.append(" ".join(words))
    monkeypatch.setattr(dart_minhash, "SALTED", 1)
    sizes = {r["class_size"] for r in near_duplicates(docs(list(enumerate(chain)))).collect()}
    assert similarity(bag(chain[0]), bag(chain[3])) < 0.8 and sizes == {4}
