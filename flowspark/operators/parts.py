"""What an entity view needs of its sources, in parts that can be kept by day and merged; and payloads that come late.

A part is an aggregate of sightings that folds again: folding days that were folded one by one gives what folding all
sightings gives. Large payloads take no part in it. A digest stands for each of them while sightings are grouped,
ranked and put in order, and the payload is fetched by its digest at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions import day_index, instant, partition_day, timebound
from flowspark.functions.times import PARTITION_DAY


@dataclass(frozen=True)
class Part:
    """One aggregate over sightings from some sources.

    `rows` turns the sources, already cut to a span of time, into sightings: `keys`, the columns that `values` aggregate,
    and `at`, the time of recording. `values` must give their own columns again, so that they also aggregate what
    they gave. Without them a part is a set of different keys.

    Days are those of recording, and so is the look-back, unless it is on another time of the sources (`time`). Then `latest` names
    the value that is the latest such time: what has none within the look-back is left out, which needs no day to be cut.
    """

    name: str
    sources: tuple[str, ...]
    rows: Callable[..., DataFrame]
    keys: tuple[str, ...]
    values: Callable[[], list[Column]] | None = None
    time: str = "recorded_at"
    latest: str | None = None
    lookback: str | timedelta | None = "30 days"

    def fold(self, sightings: DataFrame, *more: str) -> DataFrame:
        keys = [*more, *self.keys]
        if self.values is None:
            return sightings.select(*keys).distinct()
        return sightings.groupBy(*keys).agg(*self.values())

    def recent(self, sources: Sequence[DataFrame], now: datetime | Column | None, lookback: str | timedelta | None) -> DataFrame:
        """The part over the last `lookback`, or over everything."""
        if lookback is not None:
            sources = [timebound(source, self.time, now, lookback) for source in sources]
        return self.fold(self.rows(*sources))

    def by_day(self, sources: Sequence[DataFrame], days: Sequence[int] | None = None, since: datetime | None = None) -> DataFrame:
        """The part by day of recording (whole days since the epoch), of certain days or all, from the instant `since` on."""
        at, cut = F.col("recorded_at"), []
        for source in sources:
            source = source.where(at.isNotNull())
            if days is not None:
                source = source.where(day_index(at).isin(*days))
                if partition_day(source):
                    source = source.where(F.col(PARTITION_DAY).isin(*days))
            cut.append(source if since is None else source.where(at >= instant(since)))
        return self.fold(self.rows(*cut).withColumn(PARTITION_DAY, day_index(F.col("at"))), PARTITION_DAY)


def digest_of(payload: Column) -> Column:
    """What stands for a payload: the same for the same text only. Null stays null."""
    return F.sha2(payload, 256)


def payload_part(name: str, sources: tuple[str, ...], rows: Callable[..., DataFrame]) -> Part:
    """Payloads (column `payload`) as they came, each once, under their `digest`."""

    def keyed(*tables: DataFrame) -> DataFrame:
        return rows(*tables).withColumn("digest", digest_of(F.col("payload")))

    return Part(name, sources, keyed, ("digest",), lambda: [F.max("payload").alias("payload")])


def with_payload(df: DataFrame, payloads: DataFrame, name: str, digest: str = "digest") -> DataFrame:
    """The rows with the payload their `digest` stands for as `name`, instead of the digest.

    Digests are unique in `payloads`, so the optimizer leaves the join out where the payload is not asked for.
    """
    stored = payloads.select(F.col("digest").alias("_digest"), F.col("payload").alias(name))
    return df.join(stored, F.col(digest) == F.col("_digest"), "left").drop(digest, "_digest")


def counted() -> list[Column]:
    """For events that multiply what they are joined to: how often each was seen."""
    return [F.sum("times").alias("times")]


def repeated(events: DataFrame) -> DataFrame:
    """Each counted event as often as it was seen."""
    return events.withColumn("_again", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).drop("times", "_again")


@dataclass(frozen=True)
class EntityView:
    """A view of entities: its parts, further views that it takes, and how it is made of both."""

    build: Callable[..., DataFrame]
    parts: tuple[Part, ...]
    views: tuple[str, ...] = ()
