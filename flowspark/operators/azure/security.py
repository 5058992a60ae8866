"""Detections over enriched network security group flow logs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions import ago, hour_start, tag, timebound
from flowspark.operators.joins import BROADCAST_LIMIT_BYTES, candidate_join, with_listed_end
from flowspark.operators.moments import deviation, mean


def azure_listed_flows(
    flows: DataFrame, iocs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Parsed flows with a listed end: all that `azure_ioc_connections` can report, to be enriched for it."""
    spread_by = ["src_addr", "dst_addr", "src_port", "dst_port", "event_time"]
    return with_listed_end(flows, iocs, "ioc_value", "src_addr", "dst_addr", spread_by, broadcast_limit)


def azure_ioc_connections(
    flows: DataFrame, iocs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Flows allowed from a listed address, or made to one."""
    return candidate_join(
        flows,
        iocs,
        "ioc_value",
        src="src_addr",
        dst="dst_addr",
        src_counts=F.col("traffic_decision") == "ALLOWED",
        broadcast_limit=broadcast_limit,
    )


def azure_denied_counts(flows: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Denied flows of the last 25 hours per VM, role and hour, in one pass: `recent` of the last hour, `earlier` of the
    24 hours before. A flow at the instant between belongs to both.

    Baseline and scan both fold from it. Keep it (`sources.cut_lineage`) when both are wanted: it has a row per VM and hour.
    """
    at = F.col("flow_recorded_at")
    border = ago(now, "1 hour")
    return (
        timebound(flows, "flow_recorded_at", now, "25 hours")
        .where(F.col("traffic_decision") == "DENIED")
        .groupBy("src_vm_id", tag(F.col("src_vm_tags")).alias("src_role"), hour_start(at).alias("hour"))
        .agg(F.count_if(at >= border).alias("recent"), F.count_if(at <= border).alias("earlier"))
    )


def _role_counts(vms: DataFrame, now: datetime | Column | None) -> DataFrame:
    return (
        timebound(vms, "window_end", now, "25 hours", "1 hour")
        .groupBy(tag(F.col("tags")).alias("role"))
        .agg(F.count("*").alias("role_count"))
    )


# A tuple's eighth part begins like one of these, or with more spaces. A pattern would take longer than the parser.
_DENIED_TEXT = (",D", ",d", ", D", ", d", ",  ")


def azure_denied_records(raw: DataFrame) -> DataFrame:
    """Raw records whose text may hold a denied flow, to be parsed: no flow that `azure_denied_flows` keeps is in another one.

    Text with escapes is not looked into.
    """
    found = [F.col("flow_raw").contains(part) for part in (*_DENIED_TEXT, "\\")]
    return raw.where(reduce(lambda a, b: a | b, found))


def azure_denied_flows(flows: DataFrame) -> DataFrame:
    """Parsed or enriched flows that were denied: all that the baselines count, to be enriched and kept for them."""
    return flows.where(F.col("traffic_decision") == "DENIED")


def azure_hourly_denied(flows: DataFrame) -> DataFrame:
    """Denied flows per role and hour, for a baseline that rolls (`plans.RollingBaseline`)."""
    denied = azure_denied_flows(flows)
    hour = hour_start(F.col("flow_recorded_at")).alias("hour")
    return denied.groupBy(tag(F.col("src_vm_tags")).alias("src_role"), hour).agg(F.count("*").alias("n"))


def azure_denied_baseline_of_moments(
    moments: DataFrame, vms: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """`azure_denied_baseline` from the moments of hourly denied flows by role."""
    return moments.join(_role_counts(vms, now), F.col("src_role") == F.col("role"), "left").select(
        mean(F.col("role_count")).alias("avg_denied_count"),
        deviation(F.col("role_count")).alias("stddev_denied_count"),
        "src_role",
    )


def azure_denied_baseline_of(counts: DataFrame, vms: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """`azure_denied_baseline` from `azure_denied_counts`."""
    hourly = counts.groupBy("src_role", "hour").agg(F.sum("earlier").alias("denied")).where("denied > 0")
    rate = F.try_divide(F.col("denied"), F.col("role_count"))
    return (
        hourly.join(_role_counts(vms, now), F.col("src_role") == F.col("role"), "left")
        .groupBy("src_role")
        .agg(F.avg(rate).alias("avg_denied_count"), F.stddev(rate).alias("stddev_denied_count"))
        .select("avg_denied_count", "stddev_denied_count", "src_role")
    )


def azure_port_scanning_of(counts: DataFrame, baseline: DataFrame, k: float = 1) -> DataFrame:
    """`azure_port_scanning` from `azure_denied_counts`."""
    limit = F.col("avg_denied_count") + k * F.col("stddev_denied_count")
    return (
        counts.where("recent > 0")
        .join(baseline, "src_role")
        .where(F.col("recent") > limit)
        .select("src_vm_id", F.col("recent").alias("role_denied_count"), "src_role")
    )


def azure_denied_baseline(
    flows: DataFrame, vms: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """Per source role: mean and deviation over hours of denied flows per VM, 25 h to 1 h ago.

    A role without a VM in that time, such as no role at all, has a null baseline.
    """
    return azure_denied_baseline_of(azure_denied_counts(flows, now), vms, now)


def azure_port_scanning(
    flows: DataFrame,
    baseline: DataFrame,
    now: datetime | Column | None = None,
    k: float = 1,
) -> DataFrame:
    """VMs whose denied flows of an hour exceed mean + k deviations of their role.

    The last hour may span two clock hours, each counted by itself, so a VM may appear twice.
    """
    return azure_port_scanning_of(azure_denied_counts(flows, now), baseline, k)
