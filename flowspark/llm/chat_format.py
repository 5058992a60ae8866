"""Chat formatting by incremental black-box rendering: what a template adds with each turn tells where the turn stands.

A template is only a function from turns to text. It is rendered over successive prefixes of a conversation; two consecutive
outputs part where the new turn begins, and two renderings of the turn that differ in one stand-in character part exactly
where its text begins and meet again where it ends.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import slices

Turn = tuple[str, str]

# Turns, and characters of text, after which a template of bounded context is rendered anew from the last turns only.
WINDOW_TURNS = 32
WINDOW_CHARS = 1 << 20

# Strings with a meaning to this template or to common ones; a text that holds one gets it back unchanged.
TURN, END = "<|turn|>", "<|end|>"
CONTROLS = [TURN, END, "<s>", "</s>", "[INST]", "[/INST]"]
# A control string, also with backslashes after its first character: escaping adds one there, reading takes one away.
CONTROL_PATTERN = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS)
_CONTROL = re.compile(CONTROL_PATTERN)
_MARKED = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)

# Two characters for private use that stand in for a text.
_PROBES = "\ue000", "\ue001"

_SPANS = pa.list_(
    pa.struct(
        [("role", pa.string()), *((n, pa.int64()) for n in ("first", "last", "text_first", "text_last")), ("loss", pa.bool_())]
    )
)
SPANS = "array<struct<role:string,first:long,last:long,text_first:long,text_last:long,loss:boolean>>"


class Template(NamedTuple):
    """How turns become text.

    `context` says on how many preceding turns the rendering of a turn may depend, None: on all of them.
    """

    render: Callable[[list[Turn]], str]
    context: int | None = None


def escape(text: str) -> str:
    """The text with every control string broken up by a backslash."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    """Undoes `escape`."""
    return _CONTROL.sub(lambda m: m[0][0] + m[0][1:].removeprefix("\\"), text) if "\\" in text else text


def _marked(turns: list[Turn]) -> str:
    names = (escape(role.replace("\\", "\\\\").replace("\n", "\\n")) for role, _ in turns)
    return "".join(f"{TURN}{name}\n{escape(text)}{END}\n" for name, (_, text) in zip(names, turns, strict=True))


MARKED = Template(_marked, 1)


def read_back(text: str) -> list[Turn]:
    """The turns in what MARKED renders; ValueError if the text is anything else."""
    turns, at = [], 0
    for m in _MARKED.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        role = re.sub(r"\\(.)", lambda e: "\n" if e[1] == "n" else e[1], unescape(m[1]))
        turns.append((role, unescape(m[2])))
    if at != len(text):
        raise ValueError("not a text of this template")
    return turns


def _agree(a: str, b: str, least: int = 0) -> int:
    """How many first characters two texts share; `least` of them are known to be equal."""
    low, high = least, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _agree_at_end(a: str, b: str, most: int) -> int:
    return _agree(a[len(a) - most :][::-1], b[len(b) - most :][::-1]) if most > 0 else 0


class Part(NamedTuple):
    """A run of turns of one conversation as rendered: spans count characters of `text`."""

    text: str
    spans: list[dict]
    stable: bool


class Incremental:
    """Renders one conversation turn by turn and finds where each turn stands."""

    def __init__(self, template: Template, trained: frozenset[str]):
        self.template, self.trained = template, trained
        self._restart([], "", 0)
        self.stable = True

    def _restart(self, window: list[Turn], out: str, offset: int) -> None:
        self.window, self.out, self.offset = window, out, offset
        self.known = len(window)
        self.chars = sum(len(text) for _, text in window)
        self.spans: list[dict] = []
        self.rewrote = False

    def add(self, turn: Turn) -> Part | None:
        """Takes the next turn; returns a finished part when the window has been rendered anew."""
        render, part = self.template.render, None
        full = render([*self.window, turn])
        cut = _agree(self.out, full)
        new = len(self.window) - self.known
        if self.template.context is not None and (new >= WINDOW_TURNS or new and self.chars > WINDOW_CHARS):
            self._compare(cut)
            part = self.close(cut)
            rest = self.window[len(self.window) - self.template.context :] if self.template.context else []
            out = render(rest) if rest else ""
            again = render([*rest, turn])
            offset = _agree(out, again)
            self.stable = part.stable and again[offset:] == full[cut:]
            self._restart(rest, out, offset)
            full, cut = again, offset
        else:
            self._compare(cut)
        if self.spans:
            self.spans[-1]["last"] = cut
        span = self._text_span(full, self.window, len(self.window), turn[0], cut)
        self.spans.append({"role": turn[0], "first": cut, "last": len(full), **span})
        self.window.append(turn)
        self.chars += len(turn[1])
        self.out = full
        return part

    def _compare(self, cut: int) -> None:
        """History is rewritten if the outputs part before the end of a text that stood in the earlier one."""
        end = self.spans[-1]["text_last"] if self.spans else self.offset
        if cut < end:
            self.rewrote, self.stable = True, False

    def _text_span(self, full: str, turns: list[Turn], k: int, role: str, least: int = 0) -> dict:
        """Where the text of turn k stands in `full`: between what two stand-ins for it have in common on either side."""
        a, b = (self.template.render([*turns[:k], (role, p), *turns[k + 1 :]]) for p in _PROBES)
        first = _agree(a, b, least if a[:least] == b[:least] else 0)
        behind = _agree_at_end(a, b, min(len(a), len(b)) - first)
        last = len(full) - behind
        found = a != b and first <= last and full[:first] == a[:first] and full[last:] == a[len(a) - behind :]
        if not found:
            self.stable = False
            return {"text_first": least, "text_last": least, "loss": False}
        return {"text_first": first, "text_last": last, "loss": role in self.trained}

    def close(self, end: int | None = None) -> Part:
        """What has been rendered since the last part."""
        end = len(self.out) if end is None else end
        if self.spans:
            self.spans[-1]["last"] = max(end, self.spans[-1]["text_last"])
        if self.rewrote:
            for i, span in enumerate(self.spans):
                span |= self._text_span(self.out, self.window, self.known + i, span["role"])
                span |= {"first": span["text_first"], "last": span["text_last"]}
            end = len(self.out)
        for span in self.spans:
            for name in ("first", "last", "text_first", "text_last"):
                span[name] = max(0, span[name] - self.offset)
        return Part(self.out[self.offset : end], self.spans, self.stable)


def _formatted(template: Template, trained: frozenset[str]):
    names = ["conv_id", "part", "text", "spans", "stable"]

    def format_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, current, state, number, rows, held = None, None, None, 0, [], 0

        def batch() -> pa.RecordBatch:
            arrays = [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int32())]
            arrays += [pa.array([r[2].text for r in rows], pa.string()), pa.array([r[2].spans for r in rows], _SPANS)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([r[2].stable for r in rows], pa.bool_())], names)

        for piece in slices(batches):
            kind = piece.schema.field("conv_id").type
            columns = (piece.column(n).to_pylist() for n in ("conv_id", "role", "text"))
            for conv, role, text in zip(*columns, strict=True):
                if state is None or conv != current:
                    if state is not None:
                        rows.append((current, number, state.close()))
                        held += len(rows[-1][2].text)
                    current, state, number = conv, Incremental(template, trained), 0
                part = state.add((role or "", text or ""))
                if part is not None:
                    rows.append((current, number, part))
                    held += len(part.text)
                    number += 1
                if held > WINDOW_CHARS or len(rows) > 1000:
                    yield batch()
                    rows, held = [], 0
        if state is not None:
            rows.append((current, number, state.close()))
        if rows:
            yield batch()

    return format_sorted


def format_chats(conversations: DataFrame, template: Template = MARKED, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Each conversation as the template renders it, with the place of every turn and the mask of what is learned.

    Rows of `conversations` (conv_id, turn, role, text) are dealt by conv_id and sorted by turn, ties by role and text, nulls
    first; a task then streams through them and holds a window of turns, never a conversation, unless the template
    depends on all of them (`context=None`). Longer conversations come as several parts, whose texts in order are the
    whole rendering; where a window begins, its first turn is compared with the rendering in the window before.

    Returns conv_id, part (from 0), text, spans (for each turn role, first and last of what the turn added, text_first and
    text_last of its text, last exclusive, and whether it is learned: text of the `trained` roles), and stable. A template
    that rewrites history, as by dropping earlier texts when a turn follows, or that needs more context than it declares,
    makes its parts not stable; where it rewrites, each text is located in the final rendering of its window instead.
    A tail that moves behind each new turn isn't a rewrite. A text that the template doesn't show is not learned and
    its part not stable.

    Null roles and texts are empty; a null conv_id is a conversation of its own; repeated rows are turns of their own. An empty table
    gives no rows. Other columns are not read. Parts of a conversation come one after the other from one task.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = turns.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = f"conv_id {kind}, part int, text string, spans {SPANS}, stable boolean"
    return ordered.mapInArrow(_formatted(template, frozenset(trained)), schema)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "stable"]
    kind, rows, state = None, [], None

    def finished() -> tuple:
        conv, n, turns, chars, loss, length, stable = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, stable

    def batch() -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    for piece in batches:
        kind = piece.schema.field("conv_id").type
        columns = (piece.column(n).to_pylist() for n in ("conv_id", "part", "text", "spans", "stable"))
        for conv, part, text, spans, stable in zip(*columns, strict=True):
            if part == 0:
                if state is not None:
                    rows.append(finished())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
            for role, said in read_back(text):
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
            for span in spans:
                if span["loss"]:
                    learned = unescape(text[span["text_first"] : span["text_last"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
            state[5] += len(text)
            state[6] &= stable
        if len(rows) > 1000:
            yield batch()
            rows = []
    if state is not None:
        rows.append(finished())
    if rows:
        yield batch()


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts hold, read back from text and mask alone.

    Takes the rows of `format_chats` with MARKED as they come, in the same tasks. Returns conv_id, n_turns, turns_sha256 of role,
    line break, text, line break of each turn, loss_chars and loss_sha256 of the unescaped texts under the mask,
    formatted_chars (code points of the whole rendering) and stable.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    counts = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, stable boolean"
    return formatted.mapInArrow(_digested, f"conv_id {kind}, {counts}")


def with_probe_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose two texts are made of control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    types = {f.name: f.dataType for f in conversations.schema if f.name in ("conv_id", "turn", "role", "text")}
    row = conversations.sparkSession.range(2).select(
        F.lit(-7).cast(types["conv_id"]).alias("conv_id"),
        F.col("id").cast(types["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(row)
