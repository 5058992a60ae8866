"""String helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth(text: Column, separator: str, index: int) -> Column:
    """Element `index` (from 0) of the split text, null when there is none."""
    return F.get(F.split(text, re.escape(separator)), F.lit(index))


def text_or_null(text: Column) -> Column:
    """Trimmed lower-case text, for comparing one-letter codes."""
    return F.lower(F.trim(text))
