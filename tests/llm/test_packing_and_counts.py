import random

import numpy as np
import pytest
from conftest_llm import EDGES
from tokenizers import Tokenizer

from flowspark.llm.encoding import TextEncoder
from flowspark.llm.packing import binary_lengths, pack
from flowspark.llm.token_counts import CACHE, token_counts, tokenizer_digest


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer(bpe):
    return Tokenizer.from_file(bpe)


def test_encoder_equals_the_library(bpe, tokenizer):
    random.seed(3)
    parts = ["a", "word", "Word,", "it's", "x.\nY", " ", "  ", "\n", "\t", " ", " ", "\x1c", "é", "Ünï.", "12", "!?", "中", "<|endoftext|>", "'ll", "...", "a.b,", "\r\n", "A" * 60]
    texts = ["".join(random.choice(parts) + random.choice(["", " ", " ", " ", "\n"]) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    encoder = TextEncoder(bpe, remembered=50)
    for start in range(0, len(texts), 100):
        batch = texts[start : start + 100]
        for text, ids in zip(batch, encoder.encode(batch)):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def test_long_texts_are_cut_where_nothing_changes(bpe, tokenizer, monkeypatch):
    monkeypatch.setattr("flowspark.llm.encoding._SEGMENT", 10)
    text = "some words  and   spaces \n here, and there. " * 20
    assert np.frombuffer(TextEncoder(bpe).encode([text])[0], "<u4").tolist() == ids_of(tokenizer, text)


def test_binary_lengths():
    for n in range(1, 300):
        pieces = binary_lengths(n, 32)
        assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 32 for p in pieces) and len([p for p in pieces if p < 32]) == len(set(pieces) - {32})


def test_pieces_restore_every_row(docs, bpe, tokenizer):
    rows = pack(docs(EDGES), bpe, longest=64).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["offset"] == 0 and r["length"] == r["bucket"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    texts, current = [], []
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        if r["start"] == 0:
            current = []
        assert r["start"] == len(current)
        current += np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        if len(current) == r["doc_tokens"]:
            texts.append((r["doc_id"], current))
    expected = [(i, ids_of(tokenizer, t) + [1]) for i, t in EDGES]
    assert sorted(texts, key=repr) == sorted(expected, key=repr)


def test_counts_and_cache(spark, docs, bpe, tokenizer, tmp_path):
    path = str(tmp_path / "cache")
    expected = sorted(((i, len((t or "").encode()), len(ids_of(tokenizer, t))) for i, t in EDGES), key=repr)

    def counted(rows):
        return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts(docs(rows), bpe, path).collect()), key=repr)

    def stored():
        return spark.read.schema(CACHE).parquet(path).count()

    assert counted(EDGES) == expected
    n = len({t or "" for _, t in EDGES})
    assert stored() == n
    assert counted(EDGES) == expected and stored() == n  # all from the cache
    assert counted([*EDGES, (50, "new")])[-1][0] is None and stored() == n + 1  # only the new text was encoded
    spark.createDataFrame([(bytearray(b"x" * 32), 1, "other")], CACHE).write.mode("append").partitionBy("tokenizer").parquet(path)
    assert counted(EDGES) == expected


def test_many_misses_are_shuffled(docs, bpe, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr("flowspark.llm.token_counts.BROADCAST_DIGESTS", 0)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs(EDGES[2:5]), bpe, str(tmp_path / "c")).collect()}
    assert found == {2: 0, 3: 0, 4: len(ids_of(tokenizer, EDGES[4][1]))}


def test_another_tokenizer_has_another_digest(bpe, tmp_path):
    other = tmp_path / "t.json"
    other.write_bytes(open(bpe, "rb").read() + b" ")
    assert tokenizer_digest(bpe) != tokenizer_digest(str(other))


def test_empty_tables(docs, bpe, tmp_path):
    assert pack(docs([]), bpe).count() == 0
    assert token_counts(docs([]), bpe, str(tmp_path / "cache")).count() == 0
