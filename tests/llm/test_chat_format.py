import hashlib
import random
from datetime import date

import pytest
from conftest_llm import LONG

from flowspark.llm import chat_format
from flowspark.llm.chat_format import (
    CONTROLS,
    MARKED,
    Incremental,
    Template,
    chat_digests,
    escape,
    format_chats,
    read_back,
    unescape,
    with_probe_conversation,
)

TABLE = "conv_id long, turn int, role string, text string, part int, spans string, stable boolean, `a.b` int"
TRAINED = frozenset({"assistant"})


@pytest.fixture()
def chats(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, "s", False, 2) for r in rows], TABLE)


def parts_of(template, turns):
    state = Incremental(template, TRAINED)
    parts = [p for p in map(state.add, turns) if p is not None]
    return [*parts, state.close()]


def learned(parts):
    return [p.text[s["text_first"] : s["text_last"]] for p in parts for s in p.spans if s["loss"]]


def some_turns(n, seed=1):
    random.seed(seed)
    words = ["ok", "<b>", "</s>", "[INST]", "<\\s>", "<\\|end|>", "\\", "\n", "user", "ä", "😀", "<", "<|en", ""]
    return [(("user", "assistant")[i % 2], "".join(random.choices(words, k=random.randint(0, 6)))) for i in range(n)]


def test_escaping_is_undone():
    random.seed(5)
    pieces = [*CONTROLS, "<", "[", "\\", "\\\\", "|end|>", "/s>", "INST]", "x", "\n"]
    for _ in range(3000):
        text = "".join(random.choices(pieces, k=random.randint(0, 8)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROLS)


def test_turns_are_read_back():
    turns = [*some_turns(50), ("a\nb\\n<|turn|>", "x"), ("", "")]
    assert read_back(MARKED.render(turns)) == turns
    with pytest.raises(ValueError):
        read_back(MARKED.render(turns)[:-1])


@pytest.mark.parametrize("n", [1, 2, 31, 32, 33, 34, 64, 65, 200])
def test_parts_join_to_the_whole_rendering(n):
    turns = some_turns(n, n)
    parts = parts_of(MARKED, turns)
    assert "".join(p.text for p in parts) == MARKED.render(turns) and all(p.stable for p in parts)
    assert [unescape(t) for t in learned(parts)] == [t for r, t in turns if r == "assistant"]
    for p in parts:
        assert [s["first"] for s in p.spans] == [0, *(s["last"] for s in p.spans[:-1])] and p.spans[-1]["last"] == len(p.text)
    assert len(parts) == (n + 31) // 32


def test_long_texts_end_a_window(monkeypatch):
    monkeypatch.setattr(chat_format, "WINDOW_CHARS", 20)
    turns = [("user", "a" * 30), ("assistant", "b" * 30), ("user", ""), ("assistant", "c")]
    parts = parts_of(MARKED, turns)
    assert len(parts) > 1 and "".join(p.text for p in parts) == MARKED.render(turns)


def begun(turns):
    return "<s>" + "".join(f"[{r}]{t}" for r, t in turns)


def with_tail(turns):
    return begun(turns) + "</s>"


@pytest.mark.parametrize("render", [begun, with_tail])
def test_beginning_and_moving_tail(render):
    turns = [(("user", "assistant")[i % 2], f"text {i} [us </s") for i in range(100)]
    parts = parts_of(Template(render, 1), turns)
    assert "".join(p.text for p in parts) == render(turns) and all(p.stable for p in parts)
    assert learned(parts) == [t for r, t in turns if r == "assistant"]


def test_text_that_repeats_what_surrounds_it():
    template = Template(lambda turns: "".join(f"A{t}ab" for _, t in turns), 1)
    turns = [("assistant", t) for t in ("ab", "ax", "", "A", "abab", "b", "a")]
    assert learned(parts_of(template, turns)) == [t for _, t in turns]


def without_thoughts(turns):
    """Drops what stands before a colon from every text but the last, as templates for reasoning models do."""
    shown = [(r, t if i == len(turns) - 1 else t.split(":")[-1]) for i, (r, t) in enumerate(turns)]
    return begun(shown)


def test_rewritten_history_is_detected_and_located_in_the_last_rendering():
    turns = [("user", "q"), ("assistant", "think: yes"), ("user", "r"), ("assistant", "think: no")]
    (part,) = parts_of(Template(without_thoughts), turns)
    assert not part.stable and part.text == without_thoughts(turns)
    assert learned([part]) == [" yes", "think: no"]
    (part,) = parts_of(Template(without_thoughts), turns[:2])
    assert part.stable and learned([part]) == ["think: yes"]


def test_hidden_text_and_too_little_context_are_detected():
    hidden = Template(lambda turns: "".join(f"[{r}]" for r, _ in turns), 1)
    (part,) = parts_of(hidden, [("user", "a"), ("assistant", "b")])
    assert not part.stable and learned([part]) == []
    counted = lambda turns: "".join(f"{i}:{t}\n" for i, (_, t) in enumerate(turns))
    turns = [("assistant", "x")] * 100
    assert not all(p.stable for p in parts_of(Template(counted, 0), turns))
    (part,) = parts_of(Template(counted), turns)
    assert part.stable and part.text == counted(turns)


def digests(turns):
    marked = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    said = "".join(t for r, t in turns if r == "assistant")
    return len(turns), marked, len(said), hashlib.sha256(said.encode()).hexdigest(), len(MARKED.render(turns))


def test_table_with_odd_rows_equals_brute_force(chats):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "assistant", ""), (3, 0, "user", LONG)]
    rows += [(None, 0, "assistant", "no id"), (None, 1, "user", "no id")]
    rows += [(4, 7, "assistant", "tie"), (4, 7, "assistant", "tie"), (4, 7, "assistant", "a tie"), (4, 7, "system", "z")]
    rows += [(5, i, r, t) for i, (r, t) in enumerate(some_turns(500))]
    rows += [(6, 0, "a\nb", "</s>"), (6, 1, "assistant", "\\")]
    table = with_probe_conversation(chats(rows))
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat_digests(format_chats(table)).collect()}
    rows += [(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    key = lambda r: tuple((v is not None, v) for v in r[1:])
    expected = {}
    for r in sorted(rows, key=key):
        expected.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert got == {conv: digests(turns) for conv, turns in expected.items()}


def test_empty_table_and_other_types(spark, chats):
    assert format_chats(chats([])).count() == 0
    assert chat_digests(with_probe_conversation(chats([])).transform(format_chats)).collect()[0]["n_turns"] == 2
    dated = spark.createDataFrame([("x", date(2024, 1, d), "assistant", str(d)) for d in (2, 1)], "conv_id string, turn date, role string, text string")
    (row,) = format_chats(dated).collect()
    assert [t for _, t in read_back(row["text"])] == ["1", "2"]
