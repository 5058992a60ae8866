"""What a written table says about itself, in the metadata of a column, so that it is known again when it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

DISTINCT = "flowspark_distinct"


def marked_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Say of a table that no two of its rows agree in all of these columns."""
    return df.withMetadata(columns[0], {**df.schema[columns[0]].metadata, DISTINCT: sorted(columns)})


def is_distinct(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether a table says that no two rows agree in all of these columns, or in some of them.

    Filters and projections keep that true. Joins that repeat rows don't, so ask before them.
    """
    said = [field.metadata.get(DISTINCT) for field in df.schema]
    return any(mark is not None and set(mark) <= set(columns) & set(df.columns) for mark in said)
