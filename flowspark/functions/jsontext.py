"""JSON payloads: parsed once per row, kept as text where rows are compared.

Nested payloads stay JSON text while rows are grouped, united or made
distinct, because Spark neither groups nor orders variants and maps.

Catalyst copies an expression into every filter it pushes below it, and infers
filters from `explode`. For a parser that means parsing the same text several times.
`parse_once` and `explode_parsed` keep it to one.

`from_json` and functions with lambdas are interpreted, and so is every expression that stands inside them.
`apart` keeps an expression out of those above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(text: Column) -> Column:
    """Equal objects give equal text: compact, keys sorted. Malformed text and JSON null give null."""
    return F.nullif(F.to_json(F.try_parse_json(text)), F.lit("null"))


def as_json(value: Column) -> Column:
    """JSON text of a map, struct, array or variant; null stays null."""
    return F.to_json(value)


def document(text: Column) -> Column:
    """JSON text as a variant, to read several fields from; null when malformed.

    Put it in a column of its own (`withColumn`) before reading fields.
    """
    return F.try_parse_json(text)


def field(doc: Column, path: str, ddl: str = "string") -> Column:
    """The value at a JSON path of a document; null when absent or of another type.

    Paths are case sensitive. As text, objects and arrays come as JSON text.
    """
    return F.try_variant_get(doc, path, ddl)


def apart(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; what makes these columns is computed, and compiled, before what reads them.

    A generator with one row is what projections are not merged through.
    """
    for name in names:
        df = df.select(*[F.explode(F.array(c)).alias(c) if c == name else F.col(c) for c in df.columns])
    return df


def parse_once(df: DataFrame, text: str, ddl: str, name: str) -> DataFrame:
    """Add `name`, the JSON column `text` decoded to a struct, so that filters above do not parse again.

    A generator with one row is what filters are not copied through.
    """
    return df.select("*", F.explode(F.array(F.from_json(text, ddl))).alias(name))


def explode_parsed(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per element of a parsed array, without the filter `explode` would infer on the parser.

    Null arrays, empty arrays and null elements give no row.
    """
    return df.select("*", F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
