"""Regular outbound connections, shared by the clouds that report them: over flows, or over kept stretches of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import minute_index, minutes_between


def _variance(total: Column, squares: Column, n: Column) -> Column:
    """Sample variance from whole-number sums: exact until the one division."""
    wide = "decimal(19,0)"
    spread = n.cast(wide) * squares.cast(wide) - total.cast(wide) * total.cast(wide)
    return F.try_divide(spread.cast("double"), (n * (n - 1)).cast("double"))


def _per_minute(flows: DataFrame, host: str, src: str, dst: str, start: str, end: str) -> DataFrame:
    """Connections summed per (host, source, destination, minute), with the last one's place in the minute and duration."""
    began = F.col(start)
    # One whole number that orders the connections of a minute by start, then by
    # duration with null lowest; whole-number buffers keep this a hash aggregate.
    within = F.unix_micros(began) - F.col("_minute") * 60_000_000
    rank = within * (1 << 36) + F.coalesce(F.col("_duration") + (1 << 32), F.lit(0))
    return (
        flows.where(began.isNotNull())
        .withColumn("_minute", minute_index(began))
        .withColumn("_duration", minutes_between(began, F.col(end)))
        .withColumn("_rank", rank)
        .groupBy(host, src, dst, "_minute")
        .agg(
            F.count("*").alias("_n"),
            F.count("_duration").alias("_timed"),
            F.sum("_duration").alias("_total"),
            F.sum(F.col("_duration") * F.col("_duration")).alias("_squares"),
            F.max("_rank").alias("_last_rank"),
            F.max_by("_duration", "_rank").alias("_last_duration"),
        )
    )


def _statistics(
    parts: DataFrame, host: str, src: str, dst: str, min_count: int, max_variance: float, min_gap: float
) -> DataFrame:
    """Statistics of summed parts, and thresholds on them."""
    n, timed = F.col("beacon_count"), F.col("_timed_count")
    stats = (
        parts.groupBy(host, src, dst)
        .agg(
            F.sum("_n").alias("beacon_count"),
            F.sum("_gap").alias("_gaps"),
            F.sum("_gap_square").alias("_gap_squares"),
            F.sum("_timed").alias("_timed_count"),
            F.sum("_total").alias("_durations"),
            F.sum("_squares").alias("_duration_squares"),
        )
        .where(n > 0)
    )
    gap_variance = _variance(F.col("_gaps"), F.col("_gap_squares"), n)
    duration_variance = _variance(F.col("_durations"), F.col("_duration_squares"), timed)
    return stats.select(
        n,
        (F.col("_gaps") / n).alias("avg_prev_time_diff"),
        F.sqrt(gap_variance).alias("stddev_prev_time_diff"),
        gap_variance.alias("variance_prev_time_diff"),
        F.try_divide(F.col("_durations"), timed).alias("avg_connection_duration"),
        F.sqrt(duration_variance).alias("stddev_connection_duration"),
        host,
        src,
        dst,
    ).where(
        (n > min_count)
        & (F.col("variance_prev_time_diff") < max_variance)
        & (F.col("avg_prev_time_diff") > min_gap)
    )


def beacons(
    flows: DataFrame,
    *,
    host: str,
    src: str,
    dst: str,
    start: str,
    end: str,
    min_count: int,
    max_variance: float,
    min_gap: float,
) -> DataFrame:
    """Statistics of the gaps between connections per (host, source, destination), then thresholds.

    The gap of a connection runs to the next later one of the same host and destination, in minute
    boundaries; the latest connection has none and is left out. Connections that start at the same
    instant are ordered by duration, then by source.

    Gaps are whole minutes, so all connections of a minute but the last have gap 0. Flows are
    therefore summed per minute, map-side. The last connection of each (host, destination, minute) is
    found by an aggregate over these sums, and only these, at most one row per minute of the
    look-back, are sorted: each adds its gap to its source, the final one takes itself out. No
    window grows with the number of flows or of sources.
    """
    per_minute = _per_minute(flows, host, src, dst, start, end)
    # Two groupings of the sums in one pass: by source (kind 0) for its totals, by minute (kind 1) for its last connection.
    of_source = F.col("_kind") == 0
    folded = (
        per_minute.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1))))
        .groupBy(
            host,
            dst,
            "_kind",
            F.when(of_source, F.col(src)).alias("_src"),
            F.when(~of_source, F.col("_minute")).alias("_at"),
        )
        .agg(
            *[F.sum(c).alias(c) for c in ("_n", "_timed", "_total", "_squares")],
            F.max(F.when(~of_source, F.struct("_last_rank", src, F.col("_last_duration").alias("_took")))).alias("_latest"),
        )
    )
    in_time = Window.partitionBy(host, dst, "_kind", "_src").orderBy("_at")
    gap, took = F.col("_gap"), F.coalesce("_latest._took", F.lit(0))
    final = gap.isNull()

    def part(total: Column, correction: Column) -> Column:
        return F.when(of_source, F.coalesce(total, F.lit(0))).otherwise(F.when(final, correction).otherwise(0))

    parts = folded.withColumn("_gap", F.lead("_at").over(in_time) - F.col("_at")).select(
        host,
        F.when(of_source, F.col("_src")).otherwise(F.col(f"_latest.{src}")).alias(src),
        dst,
        part(F.col("_n"), F.lit(-1)).alias("_n"),
        F.coalesce(gap, F.lit(0)).alias("_gap"),
        (F.coalesce(gap, F.lit(0)) * F.coalesce(gap, F.lit(0))).alias("_gap_square"),
        part(F.col("_timed"), -F.col("_latest._took").isNotNull().cast("bigint")).alias("_timed"),
        part(F.col("_total"), -took).alias("_total"),
        part(F.col("_squares"), -took * took).alias("_squares"),
    )
    return _statistics(parts, host, src, dst, min_count, max_variance, min_gap)


def beacon_stretches(
    flows: DataFrame, *, host: str, src: str, dst: str, start: str, end: str, minutes: int = 60
) -> DataFrame:
    """What regular connections leave of each stretch of time, by default an hour, so that stretches can be joined.

    Per (host, source, destination, stretch), `stretch` being the number of spans of `minutes` minutes since the epoch: how many
    connections, the sums and squares of their gaps to the next within the stretch, and of their durations. The gap of a
    stretch's last connection is open: the row of its source also tells the first and last minute of (host, destination) in
    the stretch and the last connection's duration. `joined_stretches` closes it with the stretch that follows,
    `beacons_of` leaves the very last one out.

    Stretches go by the start of connections. A connection that is recorded later belongs to a stretch that is over,
    which is then made again.
    """
    per_minute = _per_minute(flows, host, src, dst, start, end)
    of_source = F.col("_kind") == 0
    folded = (
        per_minute.withColumn("stretch", F.floor(F.col("_minute") / minutes))
        .withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1))))
        .groupBy(
            host,
            dst,
            "stretch",
            "_kind",
            F.when(of_source, F.col(src)).alias("_src"),
            F.when(~of_source, F.col("_minute")).alias("_at"),
        )
        .agg(
            *[F.sum(c).alias(c) for c in ("_n", "_timed", "_total", "_squares")],
            F.max(F.when(~of_source, F.struct("_last_rank", src, F.col("_last_duration").alias("_took")))).alias("_latest"),
        )
    )
    in_time = Window.partitionBy(host, dst, "stretch", "_kind", "_src").orderBy("_at")
    gap = F.when(~of_source, F.lead("_at").over(in_time) - F.col("_at"))
    first = F.min("_at").over(in_time)
    open_end = F.when(
        ~of_source & F.col("_gap").isNull(),
        F.struct(F.col("_first").alias("first"), F.col("_at").alias("last"), F.col("_latest._took").alias("took")),
    )
    rows = folded.withColumn("_gap", gap).withColumn("_first", first)
    own = [F.when(of_source, F.coalesce(F.col(f"_{c}"), F.lit(0))).otherwise(0).alias(c) for c in ("n", "timed", "total", "squares")]
    source = F.when(of_source, F.col("_src")).otherwise(F.col(f"_latest.{src}")).alias(src)
    return _summed(
        rows.select(host, source, dst, "stretch", *own, *_gap_sums(F.col("_gap")), open_end.alias("edge")), host, src, dst
    )


_SUMS = ("n", "timed", "total", "squares", "gaps", "gap_squares")


def _gap_sums(gap: Column) -> list[Column]:
    gap = F.coalesce(gap, F.lit(0))
    return [gap.alias("gaps"), (gap * gap).alias("gap_squares")]


def _summed(rows: DataFrame, host: str, src: str, dst: str) -> DataFrame:
    """One row per source and stretch; of its edges, at most one, there is one or none."""
    return rows.groupBy(host, src, dst, "stretch").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("edge").alias("edge"))


def _followed(stretches: DataFrame, host: str, dst: str, within: list[str]) -> DataFrame:
    """Adds `_next`, the first minute of the next stretch of (host, destination) in the same group, to rows with an open end,
    and `_begin`, the first minute of the group.

    Only rows with an open end are put in order: one per stretch, however many sources there are.
    """
    open_end = F.col("edge").isNotNull()
    dealt = F.pmod(F.xxhash64(*stretches.columns), F.lit(4096))
    in_time = Window.partitionBy(host, dst, *within, "_apart").orderBy("stretch")
    return (
        stretches.withColumn("_apart", F.when(open_end, -1).otherwise(dealt))
        .withColumn("_next", F.when(open_end, F.lead("edge.first").over(in_time)))
        .withColumn("_begin", F.when(open_end, F.min("edge.first").over(in_time)))
        .drop("_apart")
    )


def joined_stretches(stretches: DataFrame, *, host: str, src: str, dst: str, ratio: int) -> DataFrame:
    """Stretches that are `ratio` times as long: what `beacon_stretches` would give for them."""
    longer = stretches.withColumn("_longer", F.floor(F.col("stretch") / ratio))
    rows = _followed(longer, host, dst, ["_longer"])
    gap = F.col("_next") - F.col("edge.last")
    added = _gap_sums(gap)
    still = F.when(
        F.col("edge").isNotNull() & F.col("_next").isNull(),
        F.struct(F.col("_begin").alias("first"), F.col("edge.last").alias("last"), F.col("edge.took").alias("took")),
    )
    return _summed(
        rows.select(
            host,
            src,
            dst,
            F.col("_longer").alias("stretch"),
            *_SUMS[:4],
            (F.col("gaps") + added[0]).alias("gaps"),
            (F.col("gap_squares") + added[1]).alias("gap_squares"),
            still.alias("edge"),
        ),
        host,
        src,
        dst,
    )


def beacons_of(
    stretches: DataFrame, *, host: str, src: str, dst: str, min_count: int, max_variance: float, min_gap: float
) -> DataFrame:
    """`beacons` from kept stretches, of whatever length, that follow each other: those of the look-back."""
    rows = _followed(stretches, host, dst, [])
    gap = F.col("_next") - F.col("edge.last")
    final = F.col("edge").isNotNull() & F.col("_next").isNull()
    took = F.coalesce("edge.took", F.lit(0))

    def but_final(name: str, taken: Column) -> Column:
        return (F.col(name) - F.when(final, taken).otherwise(0)).alias(f"_{name}")

    added = _gap_sums(gap)
    parts = rows.select(
        host,
        src,
        dst,
        but_final("n", F.lit(1)),
        but_final("timed", F.col("edge.took").isNotNull().cast("bigint")),
        but_final("total", took),
        but_final("squares", took * took),
        (F.col("gaps") + added[0]).alias("_gap"),
        (F.col("gap_squares") + added[1]).alias("_gap_square"),
    )
    return _statistics(parts, host, src, dst, min_count, max_variance, min_gap)
