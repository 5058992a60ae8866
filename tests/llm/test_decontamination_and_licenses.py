import random
import re

import pytest
from conftest_llm import EDGES, SMALL

from flowspark.llm.common import words_of
from flowspark.llm.decontaminate import benchmark_hits, character_spans, hit_count, keep_clean, windows, with_spans
from flowspark.llm.licenses import FREEDOM, NOTICE_PHRASES, Licences, evaluate, license_scan, scan_text, to_postfix


def hits_by_brute_force(text, items, width):
    words = words_of(text)
    hit, found = set(), set()
    for item_id, item in items:
        for window in windows(words_of(item), width):
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def random_case():
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choice(["A", "b", "c-d", "É", "7"]) for _ in range(n))
    items = [(i, make(rng.randint(0, 9))) for i in range(12)] + [(None, "b b"), (3, "A b c"), (50, None), (51, ""), (3, "A b c")]
    return items, [(i, make(rng.randint(0, 60))) for i in range(60)] + [(99, None), (None, "b, B!"), (99, "")]


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_hits_equal_brute_force(spark, docs, random_case, block):
    items, rows = random_case
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    found = benchmark_hits(docs(rows), benchmark, width=4, block_bytes=block).withColumn("n_hit", hit_count())
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=repr)
    expected = sorted(((i, *hits_by_brute_force(t, items, 4)) for i, t in rows), key=repr)
    assert got == expected
    clean = keep_clean(docs(rows), benchmark, width=4, block_bytes=block)
    assert clean.columns == docs([]).columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted((e[0] for e in expected if e[2] == 0), key=repr)


def test_given_documents_equal_brute_force(spark):
    docs, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    owners = {}
    for r in benchmark.collect():
        for w in windows(words_of(r["text"]), 10):
            owners.setdefault(w, set()).add(str(r["item_id"]))
    lengths = {len(w) for w in owners}
    expected = []
    for r in docs.collect():
        words, hit, found = words_of(r["text"]), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if own := owners.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        expected.append((r["doc_id"], len(words), len(hit), sorted(found)))
    got = benchmark_hits(docs, benchmark).withColumn("n_hit", hit_count()).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(expected)
    assert any(e[2] for e in expected)


def test_spans_are_offsets_of_the_original(spark, docs):
    text = "Zwölf: One,  TWO; (three) four."
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = docs([(1, text), (2, "none")])
    spans = with_spans(rows, benchmark).collect()
    assert [[text[s["start"] : s["end"]] for s in r["spans"]] for r in spans] == [["One,  TWO; (three"]]
    assert character_spans(None, []) == []


@pytest.mark.parametrize("block_bytes", [1 << 20, 10])
def test_spans_belong_to_texts(spark, docs, block_bytes):
    """Two texts under one id, null ids, repeated rows."""
    benchmark = spark.createDataFrame([(1, "one two three"), (2, "four five")], "item_id long, text string")
    texts = ["x one two three", "one two three y and four five", "none", None]
    rows = docs([(1, t) for t in texts] + [(None, texts[0]), (1, texts[0])])
    got = [(r["doc_id"], r["text"], [r["text"][s["start"] : s["end"]] for s in r["spans"]]) for r in with_spans(rows, benchmark, block_bytes=block_bytes).collect()]
    first = (texts[0], ["one two three"])
    assert sorted(got, key=repr) == sorted([(1, *first), (1, *first), (None, *first), (1, texts[1], ["one two three", "four five"])], key=repr)


def test_decontamination_of_odd_rows(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    found = benchmark_hits(docs(EDGES), none)
    assert found.count() == len(EDGES) and found.where("size(hit) > 0").count() == 0
    assert keep_clean(docs(EDGES), none).count() == len(EDGES)
    assert benchmark_hits(docs([]), none).count() == 0


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base_by_brute_force(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_equal_brute_force(spark, docs):
    rng = random.Random(4)
    parts = ["MIT", "License", "license,", "apache", "General", "public", "Public-License", "é", "mit license mit license", "\n"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(300)] + EDGES
    rows += [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = license_scan(docs(rows)).collect()
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(((i, *base_by_brute_force(t)) for i, t in rows), key=repr)
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) for r in got)
    assert license_scan(docs([])).count() == 0


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("mit", {"mit"}, 1.0),
        ("gpl-2.0-only or mit", {"gpl", "mit"}, 1.0),
        ("gpl-2.0-only and mit", {"gpl", "mit"}, 0.3),
        ("mit or apache-2.0 and gpl-3.0", {"mit", "apache", "gpl"}, 1.0),
        ("(mit or apache-2.0) and gpl-3.0", {"mit", "apache", "gpl"}, 0.3),
        ("gpl-2.0 with classpath-exception-2.0", {"gpl"}, 0.5),
        ("mit and", {"mit"}, 1.0),
        ("((mit", {"mit"}, 1.0),
        ("mit) or x", {"mit", "x"}, 1.0),
        ("mit */ and more text", {"mit"}, 1.0),
        ("strange-1.0", {"strange-1.0"}, 0.5),
    ],
)
def test_expressions(text, labels, score):
    found = evaluate(text)
    assert found[0] == labels and abs(found[1] - score) < 1e-9


def test_no_expression():
    assert evaluate("") is None and evaluate("or mit") is None and to_postfix("()") == []


def test_tags_and_notices():
    found = scan_text("// SPDX-License-Identifier: MIT OR Apache-2.0\ncode\nRedistribution and use in source and binary forms, ...")
    assert found["labels"] == "apache,bsd,mit" and found["n_base"] == 0 and found["expressions"] == ["mit or apache-2.0"]
    assert found["score"] == 0.95
    assert scan_text("Lesser General Public License")["labels"] == "gpl,lgpl"


BSD = "Copyright (c) 2020 X. All rights reserved. Redistribution and use in source and binary forms, with or without modification"


@pytest.mark.parametrize(
    "text, labels, score",
    [
        (BSD, "bsd", 0.95),
        ("GNU Lesser General Public License", "gpl,lgpl", 0.5),
        ("GNU Affero General Public License and the MIT License", "agpl,gpl,mit", 0.2),
        ("GNU General Public License. GNU Lesser General Public License", "gpl,lgpl", 0.3),
        ("All rights reserved.", "proprietary", 0.0),
        ("All rights reserved. SPDX-License-Identifier: MIT", "mit", 1.0),
        ("CC BY-NC 4.0", "cc-by-nc", 0.1),
        ("spdx license identifier mit", "", 0.0),
        ("SPDX-License-Identifier MIT", "", 0.0),
        ("// SPDX-License-Identifier : (GPL-2.0 WITH x) OR ISC */\n// spdx-license-identifier: 0BSD", "bsd,gpl,isc", 0.95),
        ("İ SPDX-License-Identifier: MIT", "mit", 1.0),
    ],
)
def test_what_binds(text, labels, score):
    found = scan_text(text)
    assert (found["labels"], found["score"]) == (labels, score)


def test_versions_and_longer_lists(docs):
    assert scan_text("Apache License, Version 2.0 and GNU General Public License v3, MIT License 2024")["versions"] == ["apache-2.0", "gpl-3.0"]
    known = Licences({"house rules": "house"}, [("house-", "house")], {"house": 0.7})
    rows = docs([(1, "By our House Rules"), (2, "SPDX-License-Identifier: house-1 or mit")])
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(rows, known).collect()}
    assert got == {1: ("house", 0.7), 2: ("house,mit", 0.7)}


def bound_by_brute_force(text):
    """Labels and freedom by comparing every place with every phrase."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    phrases = {**PHRASES, **NOTICE_PHRASES}
    at = [(i, i + len(p.split()), p) for p in phrases for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    binding = [(i, e, p) for i, e, p in at if not any((a <= i and e <= b) and (a, b) != (i, e) for a, b, _ in at)]
    labels = {phrases[p] for _, _, p in binding} | {PHRASES[p] for _, _, p in at if p in PHRASES}
    reserved = any(words[i : i + 3] == ["all", "rights", "reserved"] for i in range(len(words)))
    if reserved and not binding:
        return "proprietary", 0.0
    return ",".join(sorted(labels)), min((FREEDOM[phrases[p]] for _, _, p in binding), default=0.0)


def test_notices_equal_brute_force():
    rng = random.Random(8)
    parts = [*PHRASES, *NOTICE_PHRASES, "lesser", "gnu", "license", "all rights reserved", "cc", "by", "nc", "public", "x", "the"]
    for _ in range(2000):
        text = rng.choice([" ", ", "]).join(rng.choice(parts) for _ in range(rng.randint(0, 5)))
        found = scan_text(text)
        assert (found["labels"], found["score"]) == bound_by_brute_force(text), text
