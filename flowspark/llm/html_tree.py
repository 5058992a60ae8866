"""HTML text to a tree of elements: implied tags, void elements, raw text, entities. Never fails, whatever the markup."""

from __future__ import annotations

import html
import re

# A quote opens a value only right after "="; any other one is a character like others, and so is one that nothing closes.
_NAME = r"[^\s/>][^\s/>=]*+"
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    rf"|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[\s/]++|{_NAME}(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1
    h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table ul""".split()
)
_HEAD_PARTS = frozenset("base link meta noscript script style template title head html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELLS = ("td", "th")
_GROUPS = ("tbody", "thead", "tfoot")

# A start tag ends these open elements (of the nearest one's inside), searched upward as far as an element of the second set.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "td", "th", "table")),
    "dt": (("dt", "dd"), ("dl", "td", "th", "table")),
    "dd": (("dt", "dd"), ("dl", "td", "th", "table")),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (_CELLS, ("tr", "table")),
    "th": (_CELLS, ("tr", "table")),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    **dict.fromkeys((*_GROUPS, "caption", "colgroup"), ((*_GROUPS, "tr", "caption", "colgroup"), ("table",))),
}
# A paragraph ends where a block begins, but not outside of these.
_PARAGRAPH_SCOPE = ("td", "th", "table", "button", "caption", "object")

class Element:
    """A tag with its attributes and children, which are elements and texts."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag = tag
        self.attributes = attributes or {}
        self.children: list[Element | str] = []


def attributes_of(text: str) -> dict[str, str]:
    """Names lower-cased; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def parse(text: str) -> Element:
    """The tree of a page, under an element without a tag."""
    root = Element("")
    open_ = [root]
    places: dict[str, list[int]] = {}  # where elements of a tag stand in open_

    def last(tags: tuple[str, ...]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        at = last(tags)
        if at and at >= last(scope):
            while len(open_) > at:
                pop()

    def pop() -> None:
        places[open_.pop().tag].pop()

    def add(element: Element) -> None:
        open_[-1].children.append(element)
        places.setdefault(element.tag, []).append(len(open_))
        open_.append(element)

    def add_text(part: str) -> None:
        if part:
            if open_[-1].tag == "head" and not part.isspace():
                pop()
            open_[-1].children.append(html.unescape(part) if "&" in part else part)

    at, size = 0, len(text)
    while at < size:
        start = text.find("<", at)
        if start < 0:
            break
        found = _TOKEN.match(text, start)
        if not found:
            add_text(text[at : start + 1])
            at = start + 1
            continue
        add_text(text[at:start])
        at = found.end()
        if found["tag"]:
            tag = found["tag"].lower()
            if open_[-1].tag == "head" and tag not in _HEAD_PARTS:
                pop()
            if tag in BLOCKS and tag != "table":
                close(("p",), _PARAGRAPH_SCOPE)
            if tag in HEADINGS and open_[-1].tag in HEADINGS:
                pop()
            if tag in _ENDS:
                if tag == "tr" or tag in _GROUPS:
                    close(_CELLS, ("tr", "table"))
                close(*_ENDS[tag])
                if tag in _GROUPS:
                    close(_GROUPS, ("table",))
                if tag in _CELLS and open_[-1].tag in ("table", *_GROUPS):
                    add(Element("tr"))
            element = Element(tag, attributes_of(found["attributes"]) if found["attributes"].strip() else None)
            if tag in VOID:
                open_[-1].children.append(element)
            elif tag in RAW or tag in ESCAPABLE_RAW:
                ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
                inside = text[at : ending.start() if ending else size]
                element.children.append(html.unescape(inside) if tag in ESCAPABLE_RAW else inside)
                open_[-1].children.append(element)
                at = ending.end() if ending else size
            else:
                add(element)
        elif found["end"]:
            tag = found["end"].lower()
            if tag == "br":
                open_[-1].children.append(Element("br"))
            elif tag == "p" and not places.get("p"):
                open_[-1].children.append(Element("p"))
            elif tag not in ("html", "body"):
                table_part = tag in ("table", "tr", *_CELLS, *_GROUPS, "caption")
                close((tag,), ("table",) if table_part else ("table", *_CELLS))
    add_text(text[at:])
    return root
