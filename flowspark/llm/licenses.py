"""License scans: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from flowspark.llm.common import slices, words_of

# Phrases, as words, and the label each gives on its own.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further notice phrases of this operator. The longest of overlapping phrases decides how free a text is.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the mit license": "mit",
    "expat license": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "licensed under the apache license": "apache",
    "apache software license": "apache",
    "boost software license": "boost",
    "zlib license": "zlib",
    "python software foundation license": "psf",
    "artistic license": "artistic",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "server side public license": "sspl",
    "business source license": "busl",
    "open font license": "ofl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "public-domain",
    "public domain": "public-domain",
    "not in the public domain": "proprietary",
    "do what the fuck you want to public license": "public-domain",
}
# What reserves rights only where no licence is granted besides: licences with a notice of copyright say it, too.
RESERVATION = "all rights reserved"

TAG = "spdx license identifier"

# How freely a text under the licence may be used again, by label; others count as OTHER.
FREEDOM = {
    "public-domain": 1.0,
    "cc0": 1.0,
    "mit": 1.0,
    "isc": 1.0,
    "zlib": 1.0,
    "boost": 1.0,
    "bsd": 0.95,
    "apache": 0.9,
    "psf": 0.9,
    "artistic": 0.8,
    "ofl": 0.8,
    "cc-by": 0.8,
    "mpl": 0.6,
    "epl": 0.6,
    "cddl": 0.6,
    "eupl": 0.5,
    "lgpl": 0.5,
    "cc-by-sa": 0.4,
    "gpl": 0.3,
    "agpl": 0.2,
    "sspl": 0.1,
    "busl": 0.1,
    "cc-by-nc": 0.1,
    "proprietary": 0.0,
}
OTHER = 0.5
EXCEPTION_GAIN = 0.2

# An identifier belongs to the first label of which it begins with the prefix.
IDENTIFIER_PREFIXES = [
    ("mit", "mit"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("bsl-", "boost"),
    ("apache-", "apache"),
    ("bsd-", "bsd"),
    ("0bsd", "bsd"),
    ("psf-", "psf"),
    ("python-", "psf"),
    ("artistic-", "artistic"),
    ("lgpl-", "lgpl"),
    ("agpl-", "agpl"),
    ("gpl-", "gpl"),
    ("mpl-", "mpl"),
    ("epl-", "epl"),
    ("eupl-", "eupl"),
    ("cddl-", "cddl"),
    ("sspl-", "sspl"),
    ("busl-", "busl"),
    ("ofl-", "ofl"),
    ("cc0-", "cc0"),
    ("cc-by-nc", "cc-by-nc"),
    ("cc-by-sa", "cc-by-sa"),
    ("cc-by-", "cc-by"),
    ("cc-pddc", "public-domain"),
    ("unlicense", "public-domain"),
    ("wtfpl", "public-domain"),
]


class Licences(NamedTuple):
    """What is looked for, and what it means: hand in longer lists as data."""

    phrases: Mapping[str, str] = NOTICE_PHRASES
    prefixes: Sequence[tuple[str, str]] = tuple(IDENTIFIER_PREFIXES)
    freedom: Mapping[str, float] = FREEDOM


KNOWN = Licences()

_LOWER = {c: c + 32 for c in range(65, 91)}
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:_-]*")
# What follows the words of a tag: a colon, and the expression to the end of the line.
_TAGGED = re.compile(r"\s*:[ \t]*([^\r\n]*)")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_VERSION = re.compile(r"(?:version |v|v )?(\d{1,2})(?: (\d{1,2}))?(?= )")


def label_of(identifier: str, known: Licences = KNOWN) -> str:
    """The label of a licence identifier; one without a known prefix is its own."""
    return next((label for prefix, label in known.prefixes if identifier.startswith(prefix)), identifier)


def to_postfix(text: str) -> list[str]:
    """A licence expression in postfix order, by the shunting-yard method: `with` binds closest, then `and`, then `or`.

    Reading stops where the text can no longer be an expression, as at the end of a comment; an operator without a
    right side and a parenthesis without its other half are left out.

    >>> to_postfix("mit or (apache-2.0 and gpl-2.0 with x) */ text")
    ['mit', 'apache-2.0', 'gpl-2.0', 'x', 'with', 'and', 'or']
    """
    tokens, operand_next = [], True
    position = 0
    for found in _TOKEN.finditer(text):
        if text[position : found.start()].strip():
            break
        position, token = found.end(), found[0]
        if operand_next != (token == "(" or token not in _PRECEDENCE and token != ")"):
            break
        tokens.append(token)
        operand_next = token == "(" or token in _PRECEDENCE
    while tokens and (tokens[-1] in _PRECEDENCE or tokens[-1] == "("):
        tokens.pop()
    out: list[str] = []
    stack: list[str] = []
    for token in tokens:
        if token == "(":
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if stack:
                stack.pop()
        elif token in _PRECEDENCE:
            while stack and _PRECEDENCE.get(stack[-1], 0) >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
        else:
            out.append(token)
    return out + [op for op in reversed(stack) if op != "("]


def evaluate(text: str, known: Licences = KNOWN) -> tuple[set[str], float] | None:
    """Labels named by an expression and its freedom: `or` takes the freer side, `and` the stricter, an exception adds.

    None if the text begins with no licence.
    """
    stack: list[tuple[set[str], float]] = []
    for token in to_postfix(text):
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left[0], min(1.0, left[1] + EXCEPTION_GAIN)))
            else:
                stack.append((left[0] | right[0], (max if token == "or" else min)(left[1], right[1])))
        else:
            label = label_of(token, known)
            stack.append(({label}, known.freedom.get(label, OTHER)))
    return stack[-1] if stack else None


@lru_cache(maxsize=4)
def _automaton(phrases: tuple[str, ...]):
    automaton = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *phrases, RESERVATION, TAG}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()
    return automaton


def _expressions(text: str, tags: list[int]) -> Iterator[str]:
    """What stands behind tags, given by their first words: "spdx-license-identifier", a colon, and then to the end of the line."""
    lowered, wanted, number = text.lower(), set(tags), -1
    if len(lowered) != len(text):
        lowered = "".join(c.lower() if c.isascii() else c for c in text)
    begin = 0
    for number, word in enumerate(_WORD.finditer(text.translate(_LOWER))):
        if number in wanted:
            begin = word.start()
        if number - 2 in wanted and lowered[begin : word.end()] == TAG.replace(" ", "-"):
            if found := _TAGGED.match(lowered, word.end()):
                yield found[1]


def scan_text(text: str | None, known: Licences = KNOWN) -> dict:
    """Everything the scan finds in one text, see `license_scan`."""
    words = words_of(text)
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base: list[int] = []
    base_labels: set[str] = set()
    labels: set[str] = set()
    freedom: list[float] = []
    versions: set[str] = set()
    tags: list[int] = []
    reserved = False
    covered = at = word = 0
    # At one place the longest phrase comes first.
    places = sorted((end - len(p) - 1, -len(p), p) for end, p in _automaton(tuple(known.phrases)).iter(joined))
    for start, length, phrase in places:
        word += joined.count(" ", at, start)
        at = start
        if phrase == TAG:
            tags.append(word)
            continue
        if phrase == RESERVATION:
            reserved = True
            continue
        if phrase in BASE_PHRASES:
            base.append(word)
            base_labels.add(BASE_PHRASES[phrase])
        end = start - length
        if end <= covered:
            continue
        covered = end
        label = known.phrases.get(phrase) or BASE_PHRASES[phrase]
        labels.add(label)
        freedom.append(known.freedom.get(label, OTHER))
        if version := _VERSION.match(joined, end + 2):
            versions.add(f"{label}-{version[1]}.{version[2] or 0}")
    expressions = []
    for expression in _expressions(text, tags) if tags else ():
        if value := evaluate(expression, known):
            expressions.append(expression.strip())
            labels |= value[0]
            freedom.append(value[1])
    if reserved and not freedom:
        labels.add("proprietary")
        freedom.append(known.freedom.get("proprietary", 0.0))
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(base, default=None),
        "last_word": max(base, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels | base_labels)),
        "score": min(freedom, default=0.0),
        "expressions": expressions,
        "versions": sorted(versions),
    }


FOUND = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("expressions", pa.list_(pa.string())),
        ("versions", pa.list_(pa.string())),
    ]
)


def license_scan(docs: DataFrame, known: Licences = KNOWN) -> DataFrame:
    """Licence notices and identifier tags of every whole text, in one narrow pass.

    Phrases are found as consecutive words, wherever they stand, also where they overlap. Of phrases inside a longer one
    only that one binds: "lesser general public license" is no general one, though as a base phrase it counts and gives its
    label. "All rights reserved" binds where nothing is granted. A tag is read where the automaton finds its words: a colon must
    follow, and its expression is read to the end of the line. `score` is how freely the text may be used: the least over all
    that binds; 0 for a text without any, for nothing then permits its use. `versions` are labels with the version named right
    behind their phrase. Commas within a tag's identifier cannot occur. `known` has the phrases, identifiers and freedoms.

    Returns doc_id, n_words, n_base (places of base phrases), first_word, last_word (of those places), base_labels, labels,
    score, expressions, versions, one row for each row of `docs`, also for null or repeated ids. A null or empty text has no words,
    no labels (empty strings) and null places. Other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan_text(t, known) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[f.name] for r in rows], f.type) for f in FOUND]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *FOUND.names])

    return docs.select("doc_id", "text").mapInArrow(
        scan,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, expressions array<string>, versions array<string>",
    )
