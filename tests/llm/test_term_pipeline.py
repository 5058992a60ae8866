import math
import random
from collections import Counter

import pytest
from conftest_llm import EDGES

from flowspark.llm.common import words_of
from flowspark.llm.term_pipeline import ranked


def brute_force(docs, items, top=10):
    """Scores of every document for every item, in Python integers; ties beyond doc_id aren't told apart."""
    terms = [(i, Counter(words_of(t))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, n_terms = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in terms:
            m = 100 - 75 + (75 * sum(counts.values()) * n_docs) // n_terms
            score = 0
            for term in words_of(text):
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        out += [(item_id, k + 1, i if there else None, -s) for k, (s, there, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.fixture()
def items(spark):
    return lambda rows: spark.createDataFrame([(*r, 7, 1, 2) for r in rows], "item_id string, text string, item long, block int, `a.b` int")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some_texts(n, seed):
    """Words of Zipf-like frequency, so early owners leave much to be dropped."""
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [" ".join(random.choices(words, weights, k=random.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize(("shard", "block", "top"), [(16_384, 256, 10), (7, 2, 3), (1, 1, 1)])
def test_equals_brute_force(docs, items, shard, block, top):
    texts = list(enumerate(some_texts(300, 1)))
    copies = [(1000 + i, texts[5][1]) for i in range(100)]
    asked = [(f"q{i}", t) for i, t in enumerate(some_texts(12, 2))] + [("copy", texts[5][1]), ("again", "w1 w1 w1 w300")]
    if shard == 1:
        texts, copies, asked = texts[:40], copies[:5], asked[-4:]
    table = docs(texts + copies).repartition(5)
    assert rows_of(ranked(table, items(asked), top, shard, block)) == brute_force(texts + copies, asked, top)


def test_odd_rows(docs, items):
    asked = [("a", "one TWO seven"), ("a", "text"), ("a", "text"), (None, "text without an id"), ("n", None), ("e", ""), ("s", " .,!")]
    asked += [("long", "lorem amet ipsum " * 5000), ("mixed", "ñandú 中文 ÄÖÜ x"), ("unknown", "zzz qqq")]
    assert rows_of(ranked(docs(EDGES), items(asked))) == brute_force(EDGES, asked)


def test_equal_scores_and_repeated_rows(docs, items):
    rows = [(i, "same words here") for i in (5, 3, None, 9, 3, 1)] + [(7, "others")]
    got = rows_of(ranked(docs(rows), items([("q", "words")]), top=4))
    assert [(r[1], r[2]) for r in got] == [(1, None), (2, 1), (3, 3), (4, 3)]
    assert got == brute_force(rows, [("q", "words")], 4)


def test_empty_tables(docs, items):
    assert rows_of(ranked(docs([]), items([("q", "a")]))) == []
    assert rows_of(ranked(docs([(1, "a")]), items([]))) == []
    assert rows_of(ranked(docs([(1, None), (2, "")]), items([("q", "a")]))) == []


def test_a_word_of_every_document_has_the_least_weight(docs, items):
    rows = [(i, "the" if i else "the cat") for i in range(50)]
    assert rows_of(ranked(docs(rows), items([("q", "the cat")]))) == brute_force(rows, [("q", "the cat")])


def test_ids_of_other_types(spark, items):
    table = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x"), ("ä", "z")], "doc_id string, text string")
    got = rows_of(ranked(table, items([("q", "x y")])))
    assert [(r[1], r[2]) for r in got] == [(1, "a"), (2, "b"), (3, None)]
    small = spark.createDataFrame([(2, "x"), (1, "x"), (3, "y")], "doc_id smallint, text string")
    assert [(r[1], r[2]) for r in rows_of(ranked(small, items([("q", "x")])))] == [(1, 1), (2, 2)]
