"""Token ids of whole texts as the `tokenizers` library gives them, with words that were met before remembered."""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

from flowspark.llm.common import forgettable

# A task has one core; the library's own threads would only compete.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Within three characters of white space (or two at the end) a byte-level pre-tokenizer may join some.
_UNSAFE = re.compile(r"\s[ \n](?:\s|\Z)")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
# Stands for a line break before a word, as no mark stands for a space.
_BREAK = "\0"
# A run of these marks after a letter is a piece of its own.
_MARKS = ".,!"
_LAST_LATIN = "\u024f"
# How a byte-level model writes bytes: printable ones as they are, the others as the characters from 256 on, in their order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN) if b != 9}
_SEGMENT = 1 << 20
# Longer words are not remembered.
_LONG_WORD = 40


class TextEncoder:
    """Encodes texts without begin, end or added special tokens, without truncation or padding.

    A byte-level pre-tokenizer begins a new piece at every single space or line break (two at most may follow each other), so
    the ids of a text are those of its first word and of each further word with the space or break before it. Marks that
    end a word are a piece as well. Ids of about `remembered` words are kept in a dictionary; when it is full, only the words
    of the last batch stay. Other stretches of white space are cut at single spaces only. Texts that hold a special token's
    string, and tokenizers of other kinds, take the library's call on the whole text.
    """

    def __init__(self, path: str, remembered: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if hasattr(self.tokenizer.model, "_resize_cache"):
            # Words are remembered here; asked for once each, they would only fill the library's own cache.
            self.tokenizer.model._resize_cache(0)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
        )
        self.special = [token["content"] for token in spec.get("added_tokens", [])]
        self.remembered = remembered
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        ids = [array("I", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for one in ids:
                one.byteswap()
        return [one.tobytes() for one in ids]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """As `_whole`, of letters behind one space or line break, by the library's model alone: nothing is left to pre-tokenize."""
        mapped = "\t".join([p[1:] if p[0] == "\n" else p for p in pieces]).encode().decode("latin-1").translate(_ALPHABET).split("\t")
        tokenize = self.tokenizer.model.tokenize
        line = self._whole(["\n"])[0]
        out = []
        for piece, text in zip(pieces, mapped):
            ids = array("I", [token.id for token in tokenize(text)])
            if sys.byteorder == "big":
                ids.byteswap()
            out.append(line + ids.tobytes() if piece[0] == "\n" else ids.tobytes())
        return out

    def _segments(self, text: str):
        """Cuts a long text at spaces where a new piece begins anyway; the space stays with what follows."""
        start = 0
        while len(text) - start > _SEGMENT and (cut := _BOUNDARY.search(text, start + _SEGMENT)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; null is empty."""
        out: list[bytes] = [b""] * len(texts)
        cut: list[tuple[int, list[str], list[bytes | None]]] = []
        heads: list[str] = []
        for i, text in enumerate(texts):
            if text and (not self.by_word or _BREAK in text or any(s in text for s in self.special)):
                out[i] = self._whole([text])[0]
            elif text:
                for segment in self._segments(text):
                    if _UNSAFE.search(segment):
                        head, *words = _BOUNDARY.split(segment)
                    else:
                        head, *words = segment.replace("\n", " " + _BREAK).split(" ")
                    heads.append(head)
                    cut.append((i, words, list(map(self.memo.get, words))))
        lacking = [[k for k, ids in enumerate(found) if ids is None] for _, _, found in cut]
        ids_of = self._new({words[k] for (_, words, _), at in zip(cut, lacking) for k in at})
        for (i, words, found), at, head in zip(cut, lacking, self._whole(heads)):
            for k in at:
                found[k] = ids_of[words[k]]
            out[i] += head + b"".join(found)
        if len(self.memo) > self.remembered:
            self.memo = {w: ids for _, words, found in cut for w, ids in zip(words, found) if len(w) <= _LONG_WORD}
        self.memo.update((w, ids) for w, ids in ids_of.items() if len(w) <= _LONG_WORD)
        return out

    def _new(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words with the space or line break before them."""
        memo, marks = self.memo, self.marks
        marked = []
        encoded = set()
        for w in words:
            core = w.rstrip(_MARKS)
            if core != w and core and core[-1].isalpha() and core[-1] <= _LAST_LATIN:
                marked.append((w, core))
                if core not in memo:
                    encoded.add(core)
            else:
                encoded.add(w)
        letters = [w for w in encoded if w.removeprefix(_BREAK).isalpha() and max(w) <= _LAST_LATIN]
        whole = list(encoded.difference(letters))
        fresh = dict(zip(whole, self._whole(["\n" + w[1:] if w[:1] == _BREAK else " " + w for w in whole])))
        fresh.update(zip(letters, self._pieces(["\n" + w[1:] if w[:1] == _BREAK else " " + w for w in letters])))
        if len(marks) > 1000:
            marks.clear()
        for w, core in marked:
            end = w[len(core) :]
            if end not in marks:
                marks[end] = self._whole([end])[0]
            fresh[w] = (memo.get(core) or fresh[core]) + marks[end]
        return fresh


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder a worker process."""
    return TextEncoder(path)


forgettable(encoder.cache_clear)
