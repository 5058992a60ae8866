"""Time semantics shared by all operators: "now", look-backs, minute gaps, lifetimes."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day of the recording time, in whole days since the epoch, which `sources.materialize` partitions by.
# The name is reserved: only `materialize` writes it, and readers drop foreign columns they did not declare. Flow
# operators pass it on, so that look-backs above them still prune; see `timebound`.
PARTITION_DAY = "flowspark_recorded_day"
RECORDING_TIMES = ("recorded_at", "flow_recorded_at")


def instant(now: datetime | Column | None) -> Column:
    """"Now" as a column: a foldable literal for a datetime, else the query's own start time."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    return F.lit(now.astimezone(timezone.utc).isoformat(sep=" ")).cast("timestamp")


def _interval(span: str | timedelta) -> Column:
    return F.lit(span) if isinstance(span, timedelta) else F.expr(f"INTERVAL {span}")


def ago(now: datetime | Column | None, span: str | timedelta) -> Column:
    """The instant `span` ("30 days", "4 hours", a timedelta) before now."""
    return instant(now) - _interval(span)


def timebound(
    df: DataFrame,
    column: str,
    now: datetime | Column | None,
    lookback: str | timedelta,
    until: str | timedelta | None = None,
) -> DataFrame:
    """Keep rows of the last `lookback`, or between `lookback` and `until` ago, both ends included.

    On a table partitioned by day (see `sources.materialize`) the same bound
    is put on the partition column, so older directories are never listed. Days are
    counted from the instants alone, so writer and reader may differ in time zone.
    """
    start = ago(now, lookback)
    bound = F.col(column) >= start
    if until is not None:
        bound = bound & (F.col(column) <= ago(now, until))
    if column in RECORDING_TIMES and partition_day(df):
        bound = bound & (F.col(PARTITION_DAY) >= day_index(start))
        if until is not None:
            bound = bound & (F.col(PARTITION_DAY) <= day_index(ago(now, until)))
    return df.where(bound)


def partition_day(df: DataFrame) -> list[str]:
    """The partition day column, when the data has one: of that name and of whole numbers."""
    return [PARTITION_DAY] if dict(df.dtypes).get(PARTITION_DAY) == "int" else []


def day_index(ts: Column) -> Column:
    """Whole days (UTC) since the epoch, whatever the session's time zone."""
    return F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")


def hour_start(ts: Column) -> Column:
    """The instant at which the hour (UTC) began, whatever the session's time zone."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(3600)) * 3600)


def hour_of_day(ts: Column) -> Column:
    """0 to 23 (UTC), whatever the session's time zone."""
    return F.pmod(F.floor(F.unix_seconds(ts) / F.lit(3600)), F.lit(24)).cast("int")


def minute_index(ts: Column) -> Column:
    """Whole minutes since the epoch."""
    return F.floor(F.unix_seconds(ts) / F.lit(60))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from `start` to `end` (00:00:59 to 00:01:01 is 1).

    Spark's own timestampdiff counts whole elapsed minutes instead.
    """
    return minute_index(end) - minute_index(start)


def in_window(ts: Column, start: Column, end: Column, open_end: bool = True) -> Column:
    """`start <= ts <= end`; a null end means "still alive" unless `open_end` is False."""
    before_end = ts <= end
    if open_end:
        before_end = before_end | end.isNull()
    return (ts >= start) & before_end


def launch_instant(text: Column) -> Column:
    """A timestamp from ISO text or from an epoch written in digits, in seconds or milliseconds.

    Digits up to 31536000000 are seconds, above that milliseconds.
    """
    # Looks before it casts: a cast that fails is slow.
    digits = F.when(text.rlike("^[0-9]{1,18}$"), text.cast("bigint"))
    return (
        F.when(digits.isNull(), F.try_to_timestamp(text))
        .when(digits >= F.lit(31_536_000_000), F.timestamp_millis(digits))
        .otherwise(F.timestamp_seconds(digits))
    )
