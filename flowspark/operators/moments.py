"""Mean and deviation from sums that can be merged, and taken apart again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = ("hours", "total", "squares")


def moments_of(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the number of hours that have a count `n`, the sum of the counts and of their squares: whole numbers, so exact."""
    n = F.col("n").cast("decimal(38,0)")
    return counts.groupBy(*keys).agg(
        F.count("n").alias("hours"), F.sum("n").alias("total"), F.sum(n * n).cast("decimal(38,0)").alias("squares")
    )


def combined(keys: list[str], *signed: tuple[int, DataFrame]) -> DataFrame:
    """Moments added up, or taken away where the sign is -1. Keys without an hour left are gone."""
    parts = [part.select(*keys, *[(F.col(c) * sign).alias(c) for c in SUMS]) for sign, part in signed]
    both = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(c).cast("bigint" if c != "squares" else "decimal(38,0)").alias(c) for c in SUMS]
    return both.groupBy(*keys).agg(*sums).where("hours > 0")


def mean(per: Column | None = None) -> Column:
    """Mean of the counts, each divided by `per`."""
    found = F.col("total") / F.col("hours")
    return found if per is None else F.try_divide(found, per)


def deviation(per: Column | None = None) -> Column:
    """Sample deviation of the counts, each divided by `per`; null for a single hour."""
    n, total = F.col("hours").cast("decimal(19,0)"), F.col("total").cast("decimal(19,0)")
    spread = (n * F.col("squares") - total * total).cast("double")
    found = F.sqrt(F.try_divide(spread, (F.col("hours") * (F.col("hours") - 1)).cast("double")))
    return found if per is None else F.try_divide(found, per)
