"""Telling records that cannot be read from those that can, before rows vanish where they are exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark import schemas

CORRUPT = "_corrupt_record"
# Where JSON lines keep a line that is no JSON, or not of the declared types.
LINE = "line"


def _unreadable(text: Column, ddl: str | None) -> Column:
    """Whether JSON text is malformed or, with a schema, of other types than declared. No text at all is readable."""
    if ddl is None:
        return text.isNotNull() & F.try_parse_json(text).isNull()
    decoded = F.from_json(text, f"{ddl}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return text.isNotNull() & decoded[CORRUPT].isNotNull()


def bad_record(name: str, columns: list[str]) -> Column:
    """The first JSON column of a source that can't be read in a row, "line" for a whole line of JSON lines; null if all can."""
    found = F.when(F.col(CORRUPT).isNotNull(), LINE) if CORRUPT in columns else None
    for column, ddl in schemas.PAYLOADS.get(name, {}).items():
        bad = _unreadable(F.col(column), ddl)
        found = F.when(bad, column) if found is None else found.when(bad, column)
    return F.lit(None).cast("string") if found is None else found


def admit(df: DataFrame, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write a source's rows in one pass, those with an unreadable record apart; returns both as read back.

    The second table, the quarantine, has the rows as they came and `bad_record`, the column that can't be read. Every row
    is in exactly one of the two. Give it what `read_source` returns, for JSON lines with `keep_corrupt`, so that
    lines that are no JSON are in the quarantine, too.
    """
    marked = df.withColumn("bad_record", F.coalesce(bad_record(name, df.columns), F.lit("")))
    # Records are JSON text, which zstd makes much smaller than the default does.
    marked.write.mode("overwrite").partitionBy("bad_record").option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(marked.schema).parquet(path)
    good = F.coalesce(F.col("bad_record"), F.lit("")) == ""
    return written.where(good).drop("bad_record", CORRUPT), written.where(~good)
