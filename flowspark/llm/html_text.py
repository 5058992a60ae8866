"""HTML extraction: the visible text of a page, laid out in lines as a reader sees it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from flowspark.llm.common import slices
from flowspark.llm.html_tree import BLOCKS, HEADINGS, Element, parse

_HIDDEN_TAGS = frozenset(
    """area audio base canvas datalist embed head iframe link map meta noembed noframes noscript object param rp script source
    style svg template title track video""".split()
)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(?:!\s*important\s*)?(?=;|$)", re.I)
_SHOWN_INPUTS = frozenset("submit button reset text search email url tel".split())
_SPACED = frozenset("p blockquote dl figure fieldset ol ul menu dir pre table".split()) | HEADINGS
_LISTS = frozenset("ul ol menu dir".split())
_ROW_GROUPS = ("tbody", "thead", "tfoot")
_WHITE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([+-]?\d{1,6})")
# Columns that one cell may span, as browsers have it, and columns in which cells are aligned and may be spanned at all:
# a cell behind them stands two spaces after the one before.
_WIDEST_SPAN = 1000
_COLUMNS = 1000
# Characters by which a column may be widened. A longer line pushes only what follows it in its own row.
_WIDEST_COLUMN = 120
# So many lists, quotes and tables inside one another are laid out as blocks of lines. Further ones keep texts, bullets and
# rows, but are not indented more, and their cells are apart but not aligned: lines would grow with the depth without end.
_DEEPEST_LAYOUT = 150


def _number(text: str | None, otherwise: int) -> int:
    found = _NUMBER.match(text or "")
    return int(found[1]) if found else otherwise


def displayed(element: Element) -> bool:
    """By its tag, the `hidden` attribute, `type=hidden` and its own style; style sheets are not applied."""
    a = element.attributes
    return not (
        element.tag in _HIDDEN_TAGS
        or a
        and (
            "hidden" in a
            or element.tag == "input"
            and a.get("type", "").lower() == "hidden"
            or element.tag == "dialog"
            and "open" not in a
            or "style" in a
            and _NO_DISPLAY.search(a["style"])
        )
        or element.tag == "dialog"
        and not a
    )


def shown_inside(element: Element, shown: bool) -> bool:
    """Whether text right inside is visible: what stands around decides, unless the element's own style says otherwise."""
    style = element.attributes.get("style")
    found = _VISIBILITY.findall(style) if style else None
    return found[-1].lower() == "visible" if found else shown


def columns_of(line: str) -> int:
    """Columns a line takes: two for wide East Asian characters, none for marks on others."""
    if line.isascii():
        return len(line)
    wide = sum(unicodedata.east_asian_width(c) in "WF" for c in line)
    return len(line) + wide - sum(unicodedata.combining(c) > 0 for c in line)


class _Page:
    """Lines so far, the line that is being written, and blank lines that are due before the next."""

    def __init__(self, level: int = 0) -> None:
        self.level = level  # blocks of lines that this one is inside of
        self.mark = ""  # bullets that are due before the next text
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = True
        self.due = 0

    def text(self, text: str) -> None:
        text = _WHITE.sub(" ", text)
        if self.space:
            text = text.removeprefix(" ")
        if text:
            self.parts.append(text)
            self.space = text.endswith(" ")

    def line(self) -> None:
        """Ends the line if it holds anything."""
        if self.parts:
            self.put("".join(self.parts).rstrip(" "))
            self.parts.clear()
        self.space = True

    def put(self, line: str) -> None:
        if line or not self.due:
            if self.lines:
                self.lines += [""] * self.due
            self.due = 0
            if line:
                line, self.mark = self.mark + line, ""
            self.lines.append(line)

    def gap(self, n: int) -> None:
        self.line()
        self.due = max(self.due, n)

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        for i, line in enumerate(lines):
            self.put((first if i == 0 else rest) + line if line or i == 0 and first else "")


def _run(steps: Generator):
    """What a generator returns that yields others for what they return; a stack of its own instead of calls, for any depth."""
    stack, value = [steps], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def _lines(children: list, depth: int, pre: bool = False, level: int = 0, shown: bool = True) -> Generator:
    page = _Page(level)
    yield _render(children, page, depth, pre, shown)
    page.line()
    while page.lines and not page.lines[-1]:
        page.lines.pop()
    return page.lines


def _block(children: list, page: _Page, depth: int, pre: bool, first: str, rest: str, shown: bool) -> Generator:
    """Lines behind a mark or indented."""
    if page.level < _DEEPEST_LAYOUT:
        page.add((yield _lines(children, depth, pre, page.level + 1, shown)), first, rest)
        return
    before = len(page.mark)
    page.mark += first.lstrip()
    yield _render(children, page, depth, pre, shown)
    page.line()
    page.mark = page.mark[:before]


def _render(children: list, page: _Page, depth: int, pre: bool, shown: bool) -> Generator:
    """Writes nodes to the page; depth counts lists around them, and text is written where it is `shown`."""
    for child in children:
        if isinstance(child, str):
            if not shown:
                continue
            if pre:
                first, *more = child.replace("\r\n", "\n").replace("\r", "\n").split("\n")
                page.parts.append(first)
                for line in more:
                    page.put("".join(page.parts).rstrip())
                    page.parts[:] = [line]
                page.space = False
            else:
                page.text(child)
            continue
        tag = child.tag
        if not displayed(child):
            continue
        inside = shown_inside(child, shown)
        if tag == "br":
            page.put("".join(page.parts).rstrip(" "))
            page.parts.clear()
            page.space = True
        elif tag == "hr":
            page.gap(0)
        elif tag == "input":
            if inside and child.attributes.get("type", "text").lower() in _SHOWN_INPUTS:
                page.text(child.attributes.get("value", ""))
        elif tag == "details" and "open" not in child.attributes:
            page.gap(0)
            summary = next((c for c in child.children if isinstance(c, Element) and c.tag == "summary"), None)
            yield _render([summary] if summary else [], page, depth, pre, inside)
            page.gap(0)
        elif tag == "table":
            page.gap(1)
            flat = page.level >= _DEEPEST_LAYOUT
            yield (_render(child.children, page, depth, False, inside) if flat else _table(child, page, depth, inside))
            page.gap(1)
        elif tag in _LISTS:
            page.gap(0 if depth else 1)
            yield _list(child, page, depth, pre, inside)
            page.gap(0 if depth else 1)
        elif tag == "li":
            page.gap(0)
            yield _block(child.children, page, depth + 1, pre, *(("* ", "  ") if inside else ("", "")), inside)
        elif tag in ("blockquote", "dd"):
            page.gap(tag == "blockquote")
            yield _block(child.children, page, depth, pre, "    ", "    ", inside)
            page.gap(tag == "blockquote")
        elif tag in ("td", "th"):
            page.text(" ")
            yield _render(child.children, page, depth, pre, inside)
            page.text(" ")
        elif tag in BLOCKS or tag in ("tr", "caption", "optgroup", "option", "legend", *_ROW_GROUPS):
            spaced = int(tag in _SPACED)
            page.gap(spaced)
            yield _render(child.children, page, depth, pre or tag == "pre", inside)
            page.gap(spaced)
        else:
            yield _render(child.children, page, depth, pre or tag in ("textarea", "xmp"), inside)


def _list(element: Element, page: _Page, depth: int, pre: bool, shown: bool) -> Generator:
    """Items behind bullets or numbers, later lines of an item under its first."""
    number = _number(element.attributes.get("start"), 1)
    for child in element.children:
        if isinstance(child, Element) and child.tag == "li":
            if not displayed(child):
                continue
            page.gap(0)
            mark = "* "
            if element.tag == "ol":
                number = _number(child.attributes.get("value"), number)
                mark = f"{number}. "
                number += 1
            inside = shown_inside(child, shown)
            mark = mark if inside else ""
            yield _block(child.children, page, depth + 1, pre, mark, " " * len(mark), inside)
        else:
            yield _render([child], page, depth, pre, shown)


class _Taken:
    """Columns that cells of rows above take, as spans in order, each until a row."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, int, int]] = []  # first column, end, row at which it ends

    def until(self, row: int) -> None:
        """Forget what ends before a row, and join neighbours that end together."""
        joined: list[tuple[int, int, int]] = []
        for first, end, last in self.spans:
            if last <= row:
                continue
            if joined and joined[-1][1] == first and joined[-1][2] == last:
                joined[-1] = (joined[-1][0], end, last)
            else:
                joined.append((first, end, last))
        self.spans = joined

    def add(self, spans: list[tuple[int, int, int]]) -> None:
        if spans:
            self.spans = sorted(self.spans + spans)


def _placed(rows: list[list[tuple[Element, bool]]]) -> Iterator[tuple[int, int, Element, bool]]:
    """Row, column, cell and whether it is shown. A cell stands in the first column that no cell before it or above takes."""
    taken = _Taken()
    for number, row in enumerate(rows):
        taken.until(number)
        column, at, added = 0, 0, []
        for cell, shown in row:
            while at < len(taken.spans) and taken.spans[at][0] <= column:
                column = max(column, taken.spans[at][1])
                at += 1
            span = min(_WIDEST_SPAN, max(1, _number(cell.attributes.get("colspan"), 1)), max(1, _COLUMNS - column))
            yield number, min(column, _COLUMNS), cell, shown
            deep = min(len(rows) - number, max(1, _number(cell.attributes.get("rowspan"), 1)))
            if deep > 1 and column < _COLUMNS:
                added.append((column, column + span, number + deep))
            column += span
        taken.add(added)


def _table(element: Element, page: _Page, depth: int, shown: bool) -> Generator:
    """Rows of cells, columns aligned; what stands in a table outside of cells comes before it, as browsers show it."""
    rows: list[list[tuple[Element, bool]]] = []
    outside: list[tuple[object, bool]] = []

    def collect(children: list, in_row: list | None, shown: bool) -> Generator:
        for child in children:
            if isinstance(child, str):
                if child.strip():
                    outside.append((child, shown))
            elif not displayed(child) or child.tag in ("colgroup", "col"):
                continue
            elif child.tag in _ROW_GROUPS:
                yield collect(child.children, None, shown_inside(child, shown))
            elif child.tag == "tr":
                rows.append([])
                yield collect(child.children, rows[-1], shown_inside(child, shown))
            elif child.tag in ("td", "th") and in_row is not None:
                in_row.append((child, shown_inside(child, shown)))
            else:
                outside.append((child, shown))

    yield collect(element.children, None, shown)
    if outside:
        for child, seen in outside:
            yield _render([child], page, depth, False, seen)
        page.line()
    laid: list[list[tuple[int, list[str]]]] = [[] for _ in rows]
    widths: dict[int, int] = {}
    for number, column, cell, seen in _placed(rows):
        lines = yield _lines(cell.children, depth + 1, level=page.level + 1, shown=seen)
        laid[number].append((column, lines))
        if _number(cell.attributes.get("colspan"), 1) <= 1 and column < _COLUMNS:
            widest = max((w for w in map(columns_of, lines) if w <= _WIDEST_COLUMN), default=0)
            widths[column] = max(widths.get(column, 0), widest)
    last = max((c for cells in laid for c, _ in cells), default=0)
    starts, at = {}, 0
    for column in range(last + 1):
        starts[column] = at
        at += widths[column] + 2 if widths.get(column) else 0
    starts[_COLUMNS] = 0
    for cells in laid:
        for i in range(max((len(lines) for _, lines in cells), default=0)):
            line, width = [], 0
            for column, lines in cells:
                if i < len(lines) and lines[i]:
                    gap = max(starts[column] - width, 2 if line else 0)
                    line += [" " * gap, lines[i]]
                    width += gap + columns_of(lines[i])
            page.put("".join(line))


def visible_text(page: str | None) -> str:
    """The visible text of a page; empty for null."""
    return "\n".join(_run(_lines(parse(page or "").children, 0)))


def extract_text(pages: DataFrame) -> DataFrame:
    """The visible text of every whole page, in one narrow pass.

    Blocks begin on lines of their own, with a blank line around paragraphs, headings, lists and tables; items have bullets
    or numbers; cells of a table stand in aligned columns; white space is otherwise one space, and kept in `pre`.

    What an element's own style hides by `visibility` hides what is inside, unless that says `visible`; of a closed `details`
    only its summary shows. Spans of cells are read as far as there are rows.

    Returns page_id, text, n_lines, one row for each row of `pages`, also for null or repeated ids. A null or empty page has
    an empty text of 0 lines. Broken markup is read as far as browsers repair it; elements may be nested to any depth,
    see `_DEEPEST_LAYOUT` for what is then laid out more simply. Other columns are not read. An empty table gives no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [visible_text(p) for p in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), pa.array(texts, pa.string())]
            columns.append(pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "text", "n_lines"])

    return pages.select("page_id", "html").mapInArrow(extract, f"page_id {kind}, text string, n_lines long")
