"""Detections over VPC flow logs.

The logs tell neither direction nor refusals. A refused attempt shows as a flow without bytes
that starts and ends at the same time: a miss.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions import ago, hour_of_day, hour_start, tag, timebound
from flowspark.operators.beaconing import beacon_stretches, beacons, beacons_of
from flowspark.operators.joins import BROADCAST_LIMIT_BYTES, candidate_join, with_listed_end
from flowspark.operators.moments import deviation, mean


_BEACON = {"host": "src_vm_name", "src": "src_ip", "dst": "dst_ip"}


def _outbound(flows: DataFrame, internal_prefix: str) -> DataFrame:
    return flows.where(F.col("src_ip").startswith(internal_prefix) & ~F.col("dst_ip").startswith(internal_prefix))


def gcp_beaconing(
    flows: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "4 hours",
    min_count: int = 100,
    max_variance: float = 0.3,
    min_gap: float = 1,
    internal_prefix: str = "10.",
) -> DataFrame:
    """Outbound connections that are made at regular intervals."""
    outbound = _outbound(timebound(flows, "recorded_at", now, lookback), internal_prefix)
    thresholds = {"min_count": min_count, "max_variance": max_variance, "min_gap": min_gap}
    return beacons(outbound, **_BEACON, start="start_time", end="end_time", **thresholds)


def gcp_beacon_hours(flows: DataFrame, internal_prefix: str = "10.", minutes: int = 60) -> DataFrame:
    """What `gcp_beaconing` needs to know of each hour, or other span, to be kept: see `beacon_stretches`."""
    return beacon_stretches(_outbound(flows, internal_prefix), **_BEACON, start="start_time", end="end_time", minutes=minutes)


def gcp_beaconing_of(
    hours: DataFrame, min_count: int = 100, max_variance: float = 0.3, min_gap: float = 1
) -> DataFrame:
    """`gcp_beaconing` over the hours given, however many."""
    return beacons_of(hours, **_BEACON, min_count=min_count, max_variance=max_variance, min_gap=min_gap)


def gcp_listed_flows(
    flows: DataFrame, iocs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Parsed flows with a listed end: all that `gcp_ioc_connections` can report, to be enriched for it."""
    spread_by = ["src_ip", "dst_ip", "src_port", "dst_port", "start_time"]
    return with_listed_end(flows, iocs, "ioc_value", "src_ip", "dst_ip", spread_by, broadcast_limit)


def gcp_ioc_connections(
    flows: DataFrame, iocs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Flows with a listed address at either end."""
    return candidate_join(
        flows, iocs, "ioc_value", src="src_ip", dst="dst_ip", broadcast_limit=broadcast_limit
    )


def gcp_missed_flows(flows: DataFrame) -> DataFrame:
    """Parsed or joined flows that are misses: all that the baselines count, to be joined and kept for them."""
    return flows.where((F.col("start_time") == F.col("end_time")) & (F.col("bytes") == 0))


def _misses(flows: DataFrame) -> DataFrame:
    return gcp_missed_flows(flows).withColumns({"src_role": tag(F.col("src_tags")), "dst_role": tag(F.col("dst_tags"))})


def gcp_miss_counts(flows: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Misses of the last 25 hours per VM, pair of roles and hour of the day, in one pass: `recent` of the last hour,
    `earlier` of the 24 hours before. A flow at the instant between belongs to both.

    Baseline and scan both fold from it. Keep it (`sources.cut_lineage`) when both are wanted: it has a row per VM and hour.
    """
    at = F.col("recorded_at")
    border = ago(now, "1 hour")
    return (
        _misses(timebound(flows, "recorded_at", now, "25 hours"))
        .groupBy("src_vm_name", "src_role", "dst_role", hour_of_day(at).alias("hourly_part"))
        .agg(F.count_if(at >= border).alias("recent"), F.count_if(at <= border).alias("earlier"))
    )


def _seen_roles(vms: DataFrame, now: datetime | Column | None) -> DataFrame:
    seen = timebound(vms, "last_seen", now, "25 hours", "1 hour")
    return seen.select(tag(F.col("tags")).alias("src_role")).distinct()


def gcp_hourly_misses(flows: DataFrame) -> DataFrame:
    """Misses per pair of roles and hour, for a baseline that rolls (`plans.RollingBaseline`)."""
    hour = hour_start(F.col("recorded_at")).alias("hour")
    return _misses(flows).groupBy("src_role", "dst_role", hour).agg(F.count("*").alias("n"))


def gcp_connect_baseline_of_moments(
    moments: DataFrame, vms: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """`gcp_connect_baseline` from the moments of hourly misses by pair of roles."""
    return moments.join(_seen_roles(vms, now), "src_role").select(
        mean().alias("avg_miss_count"), deviation().alias("stddev_miss_count"), "src_role", "dst_role"
    )


def gcp_connect_baseline_of(counts: DataFrame, vms: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """`gcp_connect_baseline` from `gcp_miss_counts`."""
    hourly = counts.groupBy("src_role", "dst_role", "hourly_part").agg(F.sum("earlier").alias("miss_count"))
    return (
        hourly.where("miss_count > 0")
        .join(_seen_roles(vms, now), "src_role")
        .groupBy("src_role", "dst_role")
        .agg(
            F.avg("miss_count").alias("avg_miss_count"),
            F.stddev("miss_count").alias("stddev_miss_count"),
        )
        .select("avg_miss_count", "stddev_miss_count", "src_role", "dst_role")
    )


def gcp_port_scanning_of(counts: DataFrame, baseline: DataFrame, k: float = 1) -> DataFrame:
    """`gcp_port_scanning` from `gcp_miss_counts`."""
    recent = counts.groupBy("src_vm_name", "dst_role", "src_role").agg(F.sum("recent").alias("miss_count"))
    limit = F.col("avg_miss_count") + k * F.col("stddev_miss_count")
    return (
        recent.where("miss_count > 0")
        .join(baseline, ["dst_role", "src_role"])
        .where(F.col("miss_count") > limit)
        .select(
            "miss_count", "src_vm_name", "dst_role", "src_role", "avg_miss_count", "stddev_miss_count"
        )
    )


def gcp_connect_baseline(
    flows: DataFrame, vms: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """Per pair of roles: mean and deviation over the hours of the day of misses, 25 h to 1 h ago.

    Only source roles of VMs last seen in that time are kept.
    """
    return gcp_connect_baseline_of(gcp_miss_counts(flows, now), vms, now)


def gcp_port_scanning(
    flows: DataFrame,
    baseline: DataFrame,
    now: datetime | Column | None = None,
    k: float = 1,
) -> DataFrame:
    """VMs whose misses of the last hour exceed mean + k deviations for their pair of roles."""
    return gcp_port_scanning_of(gcp_miss_counts(flows, now), baseline, k)
