import time
import math
import random
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from conftest_llm import EDGES, SMALL
from pyspark.sql import functions as F

from flowspark.llm import lm_scoring
from flowspark.llm.hash_search import Index, nearest
from flowspark.llm.html_text import extract_text, visible_text
from flowspark.llm.lm_scoring import learn_weights, pack_counts, pack_keys, score_texts, unpack_counts, unpack_keys

# --- language-model scoring


def tokens_of(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    data = (text or "").encode().translate(lower)
    return [w for w in data.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w] + [None]


def scores_by_brute_force(rows):
    part = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    word, pair, kept_word, kept_pair = Counter(), Counter(), Counter(), Counter()
    for i, text in rows:
        if part(i) != 2:
            tokens = tokens_of(text)
            pairs = list(zip(["start", *tokens], tokens))
            for w, p in ((word, pair), (kept_word, kept_pair))[: 1 if part(i) == 3 else 2]:
                w.update(tokens)
                w["start"] += 1
                p.update(pairs)
    total = lambda c: (sum(n for w, n in c.items() if w != "start"), len(c) - ("start" in c))
    (n, v), (kn, kv) = total(word), total(kept_word)
    grid, steps = lm_scoring._GRID, lm_scoring._STEPS
    step = lambda r: round(math.log2(r) * steps) + grid // 2 if r > 0 else 0
    bucket = lambda c: c.bit_length()
    events = Counter()
    for i, text in rows:
        if part(i) == 3:
            tokens = tokens_of(text)
            for u, w in zip(["start", *tokens], tokens):
                one, two = kept_word[w] / max(kn, 1) * (kv + 1), kept_pair[u, w] / max(kept_word[u], 1) * (kv + 1)
                events[(bucket(kept_word[u]) * grid + step(one)) * grid + step(two)] += 1
    weights = learn_weights(np.array(sorted(events), np.int64), np.array([events[c] for c in sorted(events)], float))
    out = []
    for i, text in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((word[w] + 1) / (n + 1 * (v + 1))) for w in tokens)
        score = 0.0
        for u, w in zip(["start", *tokens], tokens):
            l0, l1, l2 = weights[bucket(word[u])]
            score += math.log10(l0 / (v + 1) + l1 * word[w] / max(n, 1) + l2 * pair[u, w] / max(word[u], 1))
        out.append((i, part(i) == 2, len(tokens), sum(word[w] > 0 for w in tokens), n, base, score))
    return out


def compare(got, expected):
    order = lambda r: (repr(r[0]), r[2], round(r[5], 4))
    got, expected = sorted(map(tuple, got), key=order), sorted(expected, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=1e-9)


def test_scores_equal_brute_force(spark, docs, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"Word{i}" for i in range(60)] + ["É", "a,b"]
    text = lambda: rng.choice([" ", "\n"]).join(vocabulary[int(rng.random() ** 3 * 62)] for _ in range(rng.randint(0, 80)))
    rows = [(i, text()) for i in range(200)] + EDGES
    compare(score_texts(docs(rows)).collect(), scores_by_brute_force(rows))
    compare(score_texts(docs(EDGES[:1])).collect(), scores_by_brute_force(EDGES[:1]))
    assert score_texts(docs([])).count() == 0


def test_given_documents_in_small_chunks(spark):
    """Chunk and range sizes change nothing; the model beats the base on documents it has not seen."""
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = score_texts(table.repartition(7)).collect()
    compare(got, scores_by_brute_force(rows))
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_packing_of_keys_and_counts():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64 - 1, 1000, np.uint64))
    assert (unpack_keys(pack_keys(keys)) == keys).all() and unpack_keys(pack_keys(keys[:1])).tolist() == keys[:1].tolist()
    for counts in ([1, 2, 300], [2**40, 0], []):
        assert unpack_counts(pack_counts(np.array(counts, np.int64))).tolist() == counts


def test_weights_make_the_events_likelier():
    grid = lm_scoring._GRID
    cell = np.array([(3 * grid + grid // 2 + 8) * grid + grid // 2 + 20, (3 * grid + grid // 2 + 8) * grid])
    weights = learn_weights(cell, np.array([900.0, 100.0]))
    assert weights[3, 2] > 0.8 and np.allclose(weights.sum(axis=1), 1) and weights[0, 2] == 0
    assert (weights[5] == weights[3]).all() and (weights[:, :2] > 0).all()


# --- nearest neighbours

VECTORS = "vec_id long, embedding array<double>, score double, v string"


def found_by_brute_force(rows, is_query, k):
    """Rows of one id and several vectors are rows of their own; only vectors of one length are compared."""
    out = []
    for own, (q, x) in enumerate(rows):
        if is_query(q):
            others = [(i, y) for n, (i, y) in enumerate(rows) if n != own and len(y) == len(x)]
            scored = sorted((-float(np.dot(x, y)), i) for i, y in others)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


def test_every_code_within_the_last_ring_is_found():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**63, (2000, 4), np.uint64)
    codes[:50] = codes[0]
    index = Index(codes)
    for enough in (1, 50, 51, 300, 2000):
        for query in codes[:60:7] ^ np.uint64(3):
            found, probed = index.search(query, enough)
            apart = np.bitwise_count(codes ^ query).sum(axis=1)
            assert min(enough, 2000) <= len(found) <= probed <= 2000
            # Nothing that is left out lies nearer than what is found.
            assert sorted(found.tolist()) == np.flatnonzero(apart <= apart[found].max()).tolist() or len(found) == 2000 or (
                np.delete(apart, found).min() > apart[found].max() - 4
            )
            assert apart[found].max() < np.delete(apart, found).min(initial=10**6)


@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_recall(spark, spread, monkeypatch):
    monkeypatch.setattr("flowspark.llm.hash_search.SHARD", 500)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 24)) + 2 * rng.normal(size=(8, 24))[rng.integers(0, 8, 2000)]
    x *= (1 + spread * rng.random(2000))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0.0, "") for i, v in rows], VECTORS)
    got = nearest(df, F.col("vec_id") % 20 == 0, sample=1000, block_bytes=6000).collect()
    expected = found_by_brute_force(rows, lambda i: i % 20 == 0, 20)
    assert len(got) == len(expected)
    truth = {(q, i): s for q, _, i, s in expected}
    right = [r for r in got if (r["query_id"], r["vec_id"]) in truth]
    assert len(right) >= 0.9 * len(expected)
    assert all(abs(r["score"] - truth[r["query_id"], r["vec_id"]]) < 1e-9 for r in right)
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r)
    for rs in by_query.values():
        assert [r["rank"] for r in rs] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in rs] == sorted((-r["score"], r["vec_id"]) for r in rs)


def test_recall_and_share_probed_of_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = nearest(table, F.col("vec_id") % 20 == 0).collect()
    truth = {(q, i) for q, _, i, _ in found_by_brute_force(rows, lambda i: i % 20 == 0, 20)}
    assert sum((r["query_id"], r["vec_id"]) in truth for r in got) >= 0.95 * len(truth)
    assert np.mean([r["probed"] for r in got]) < 0.6


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 2.0, 0.5]) for i in range(0, 100, 10)] + [(i, [float(i), 1.0, -1.0]) for i in range(1, 9)]
    good += [(206, [1.0]), (240, [2.0]), (40, [3.0, 1.0, 1.0]), (7, [9.0, 9.0, 9.0]), (260, [1.0, 1.0])]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [nan, 1.0, 1.0]), (204, [inf, 1.0, 1.0]), (205, []), (None, [1.0, 1.0, 1.0]), (220, None)]
    repeated = [(0, [1.0, 2.0, 0.5]), (206, [1.0])]
    df = spark.createDataFrame([(i, v, 0.0, "") for i, v in good + bad + repeated], VECTORS)
    got = sorted(tuple(r)[:4] for r in nearest(df, F.col("vec_id") % 20 == 0).collect())
    expected = sorted(found_by_brute_force(good, lambda i: i % 20 == 0, 20))
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected])
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(df.where("vec_id = 200"), F.col("vec_id") % 20 == 0).count() == 0


def test_dimensions_without_codes_are_searched_whole(spark, monkeypatch):
    monkeypatch.setattr("flowspark.llm.hash_search.CODED", 1)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3 if i % 3 else 5).tolist()) for i in range(200)]
    df = spark.createDataFrame([(i, v, 0.0, "") for i, v in rows], VECTORS)
    got = sorted(tuple(r)[:3] for r in nearest(df, F.col("vec_id") % 30 == 0, k=5).collect())
    assert got == sorted(r[:3] for r in found_by_brute_force(rows, lambda i: i % 30 == 0, 5))


# --- HTML


def test_layout():
    page = """<html><head><title>no</title><style>p{}</style><body><h1>Head</h1>some <b>bold</b>text<p>one<p>two
    <ul><li>a<li>b<ol start=3><li>n1<li>n2</ol><li>c</ul><table><tr><th>Name<th>Value<tr><td>alpha<td>1<tr><td>b<td>22 <br>33</table>
    after<div hidden>no</div><span style="display: none">no</span><pre>\n a  b\n   c</pre>x &amp; y<!-- no --> <script>var t="</p>";</script>end"""
    assert visible_text(page).split("\n") == [
        "Head", "", "some boldtext", "", "one", "", "two", "", "* a", "* b", "  3. n1", "  4. n2", "* c", "",
        "Name   Value", "alpha  1", "b      22", "       33", "", "after", "", " a  b", "   c", "", "x & y end",
    ]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("a<b", "a"),
        ("1 < 2 &lt; 3", "1 < 2 < 3"),
        ("<p>x</p></p></div>y", "x\n\ny"),
        ("<td>cell", "cell"),
        ("<table><tr><td>a<td>b</table>", "a  b"),
        ("<table><td colspan=2>wide<tr><td>a<td>b<tr><td rowspan=2>c<td>d<tr><td>e</table>", "wide\na  b\nc  d\n   e"),
        ("<table>out<tr><td>in</table>", "out\nin"),
        ("<ul><li>a<ul><li>b</ul></ul>", "* a\n  * b"),
        ("<ol><li value=7>a<li>b</ol>", "7. a\n8. b"),
        ("<textarea>a &amp;\n b</textarea>", "a &\n b"),
        ("<style>x</style><noscript>y</noscript><template>z</template>", ""),
        ("<p style='visibility:hidden'>x</p><input type=hidden value=h><input value=v>", "v"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<p>a<hr>b", "a\n\nb"),
        ("<p style='visibility:hidden'>x <b style='visibility: visible'>y</b> z</p>", "y"),
        ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "* b"),
        ("<details>no<summary>s</summary><p>no</details>y", "s\ny"),
        ("<details open><summary>s</summary>t</details>", "s\nt"),
        ("<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>", "漢kan"),
        ("<table><tr><td>中文<td>x<tr><td>abcd<td>y</table>", "中文  x\nabcd  y"),
        ("<table><tr><td rowspan=99>a<td>b<tr><td>c</table><table><tr><td>d</table>", "a  b\n   c\n\nd"),
        ("<blockquote>q</blockquote>", "    q"),
    ],
)
def test_pages(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p class="a"">He said nothing. <b>More visible text</b></p><p class="b">Next</p>', "He said nothing. More visible text\n\nNext"),
        ("<a title=don't href=x>It isn't here</a>", "It isn't here"),
        ('<a title="x > y" href = \'a>b\'>one</a> <a b="c"d="e>f">two</a>', "one two"),
        ('<a "b>one</a> <a b==">two</a> <a b=>three</a>', "one two three"),
        ('<p a=b"hidden">shown</p><p title=it\'s hidden>no</p>', "shown"),
        ('<p a="never closed>kept <b>too</b>', "kept too"),
    ],
)
def test_stray_quotes_swallow_nothing(page, text):
    assert visible_text(page) == text


HIDING = ["<div hidden>no</div>", "<p style='display:none'>no</p>", "<noscript><b>no</b></noscript>", "<template>no</template>", "<svg><text>no</text></svg>"]


@pytest.mark.parametrize("tag", ["div", "b", "span", "font"])
@pytest.mark.parametrize("depth", [10, 200, 20_000])
def test_deep_elements_are_laid_out_as_others(tag, depth):
    inside = "".join(HIDING) + "<table><tr><td>a<td>b<tr><td>cc<td>d</table><ul><li>e<li>f</ul>"
    inside += f"<div hidden>{'<div>' * 9}{'</div>' * 9}no</div>g"
    assert visible_text(f"<{tag}>" * depth + inside).split("\n") == ["a   b", "cc  d", "", "* e", "* f", "", "g"]


@pytest.mark.parametrize("depth", [200, 20_000])
def test_deep_lists_quotes_and_tables_keep_their_parts(depth):
    inside = "".join(HIDING) + "x<ol><li>e<li hidden>no<li>f</ol>"
    for around in ("<blockquote>", "<ul><li>", "<table><tr><td>"):
        lines = [line.strip("* ") for line in visible_text(around * depth + inside).split("\n") if line]
        assert lines == ["x", "1. e", "2. f"]
    cells = visible_text("<table><tr><td>" * depth + "a<td>b<tr><td>c<td>d").split("\n")
    assert [line.split() for line in cells] == [["a", "b"], ["c", "d"]]
    assert visible_text("<ul><li>" * depth + "x").count("*") == depth


@pytest.mark.parametrize("page", ["<" * 5000, "<a " * 5000, "<div>" * 20000 + "deep", "<table><tr><td>" * 500 + "deep", "<a b=\"" + "x" * 100000, "<!--", "<a " + "'" * 10001, "<ul><li>" * 3000 + "deep"])
def test_broken_pages_end_and_keep_their_text(page):
    assert ("deep" in page) == ("deep" in visible_text(page))


@pytest.mark.parametrize("span", ["rowspan=999999 colspan=1000", "rowspan={} colspan=3", "rowspan=2 colspan=1000", "rowspan={}"])
def test_spans_end_within_seconds(span):
    """A page of a megabyte whose rows all span."""
    rows = ["<tr><td " + span.format(1 + n * 7919 % 5000) + f">c{n}" for n in range(22_000)]
    page = "<table>" + "".join(rows) + "x" * 2000
    began = time.perf_counter()
    text = visible_text(page)
    assert time.perf_counter() - began < 20 and all(f"c{n}" in text for n in (0, 999, 21_999))
    assert len(text) < 60e6


def test_long_cells_do_not_widen_their_column():
    page = "<table>" + "<tr><td>" + "x" * 100_000 + "<td>y" + "<tr><td>a<td>b" * 20_000
    assert len(visible_text(page)) < 3e6


class Words(HTMLParser):
    """All text outside of elements that never show, in order."""

    def __init__(self):
        super().__init__()
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_given_pages_keep_every_visible_letter(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    texts = {r["page_id"]: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        plain = Words()
        plain.feed(r["html"])
        plain.close()
        letters = lambda s: "".join(c for c in s if c.isalpha())
        assert letters(texts[r["page_id"]]["text"]) == letters("".join(plain.parts))
        assert texts[r["page_id"]]["n_lines"] == len(texts[r["page_id"]]["text"].split("\n"))


def test_odd_rows_of_pages(spark):
    rows = [(1, "<p>a", "x"), (1, "<p>a", "x"), (None, "<p>b", "x"), (2, None, "x"), (3, "", None), (4, "<p>" + "long " * 200000, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted(((r["page_id"], r["text"], r["n_lines"]) for r in extract_text(pages).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (1, "a", 1), (None, "b", 1), (2, "", 0), (3, "", 0), (4, ("long " * 200000).strip(), 1)], key=repr)
    assert extract_text(pages.limit(0)).count() == 0
