"""Baselines over a day of hours that roll on: an hour is added, the one a day before is taken away."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.functions import timebound
from flowspark.operators.moments import combined, moments_of
from flowspark.sources import replace_partitions

_HOUR = timedelta(hours=1)


def _number(at: datetime) -> int:
    seconds = int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp())
    if seconds % 3600:
        raise ValueError("a baseline rolls on at full hours")
    return seconds // 3600


class RollingBaseline:
    """Counts per key and hour, and their moments over the `hours` hours before the last one, in a folder that executors share.

    `counts` makes of flows the columns `keys`, hour, n, as `aws_hourly_resets` does; `time` is the time it counts by.
    `start` counts all hours once. `advance` then reads the flows of a single hour and writes its counts, new moments
    and the counts at the very instant the baseline ends, which it includes. All three are written before the state moves on, each
    under the hour it is for, so a run that was lost is repeated. `moments` are those that the whole baseline at `now` has.

    With `by_hour_of_day` the instant at the end counts to the same hour of the day before, as in `aws_rst_baseline`, else to an hour
    of its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        counts: Callable[[DataFrame], DataFrame],
        time: str = "recorded_at",
        by_hour_of_day: bool = True,
        hours: int = 24,
    ):
        self._spark, self._path, self._keys, self._counts = spark, path, list(keys), counts
        self._time, self._by_hour_of_day, self._hours = time, by_hour_of_day, hours

    def _write(self, kind: str, rows: DataFrame, hour: int) -> None:
        replace_partitions(rows.withColumn("at", F.lit(hour)), f"{self._path}/{kind}", ["at"], [{"at": hour}])

    def _read(self, kind: str, first: int, last: int) -> DataFrame:
        names = {"moments": "hours bigint, total bigint, squares decimal(38,0)"}.get(kind, "n bigint")
        keys = ", ".join(f"`{k}` string" for k in self._keys)
        table = self._spark.read.schema(f"{keys}, {names}, at int").parquet(f"{self._path}/{kind}")
        return table.where(F.col("at").between(first, last))

    def _counted(self, flows: DataFrame, now: datetime, hours: int) -> DataFrame:
        """Counts of the hours that end an hour before now, and of that very instant."""
        span = timebound(flows, self._time, now, (hours + 1) * _HOUR, _HOUR)
        number = F.floor(F.unix_seconds("hour") / 3600).cast("int")
        return self._counts(span).select(*self._keys, F.col("n").cast("bigint").alias("n"), number.alias("at"))

    def _own(self, df: DataFrame) -> DataFrame:
        return df.drop("at")

    def start(self, flows: DataFrame, now: datetime) -> None:
        """Count every hour of the baseline at `now`."""
        end = _number(now) - 1
        counted = self._counted(flows, now, self._hours)
        written = [{"at": hour} for hour in range(end - self._hours, end)]
        replace_partitions(counted.where(F.col("at") < end), f"{self._path}/hours", ["at"], written)
        self._write("edges", self._own(self._counted(flows, now, 1).where(F.col("at") == end)), end)
        self._write("moments", moments_of(self._read("hours", end - self._hours, end - 1), self._keys), end)

    def advance(self, flows: DataFrame, now: datetime) -> None:
        """Move on to `now`, an hour after the last: reads that hour's flows only."""
        end = _number(now) - 1
        counted = self._counted(flows, now, 1)
        newest, oldest = end - 1, end - 1 - self._hours
        self._write("hours", self._own(counted.where(F.col("at") == newest)), newest)
        self._write("edges", self._own(counted.where(F.col("at") == end)), end)
        moved = combined(
            self._keys,
            (1, self._read("moments", newest, newest)),
            (1, moments_of(self._read("hours", newest, newest), self._keys)),
            (-1, moments_of(self._read("hours", oldest, oldest), self._keys)),
        )
        self._write("moments", moved, end)

    def moments(self, now: datetime) -> DataFrame:
        """Moments of the baseline at `now`, which it was started at or advanced to."""
        end = _number(now) - 1
        kept, edge = self._read("moments", end, end), self._own(self._read("edges", end, end))
        if not self._by_hour_of_day:
            return combined(self._keys, (1, kept), (1, moments_of(edge, self._keys)))
        first = self._own(self._read("hours", end - self._hours, end - self._hours))
        both = first.unionByName(edge).groupBy(*self._keys).agg(F.sum("n").alias("n"))
        return combined(self._keys, (1, kept), (-1, moments_of(first, self._keys)), (1, moments_of(both, self._keys)))
