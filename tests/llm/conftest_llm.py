"""Inputs that several tests share."""

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

LONG = "lorem ipsum dolor sit amet, " * 20_000

#: Null ids and texts, empty and blank texts, repeated ids and rows, a very long text, odd characters.
EDGES = [
    (1, "One two three four five six."),
    (1, "Another text under the same id"),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (None, "a text without an id"),
    (None, None),
    (5, "repeated row of words"),
    (5, "repeated row of words"),
    (6, LONG),
    (7, "ÄÖÜ ñandú 中文 текст 😀 \u0000 end"),
    (8, "!!! ... ---"),
    (9, "x" * 300_000),
]
