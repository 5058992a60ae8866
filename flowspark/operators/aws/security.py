"""Detections over VPC flow logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions import ago, hour_of_day, hour_start, tag, timebound
from flowspark.operators.beaconing import beacon_stretches, beacons, beacons_of
from flowspark.operators.joins import BROADCAST_LIMIT_BYTES, candidate_join, with_listed_end
from flowspark.operators.moments import deviation, mean

# TCP flags of a connection being opened (SYN, SYN with FIN), and reset.
OPENING_FLAGS = (2, 3)
RESET_FLAG = 4


@dataclass(frozen=True)
class RolePolicy:
    """What each role may do, for `aws_unusual_role_ports` and `aws_ioc_connections`."""

    web_role: str = "apache"
    web_port: int = 443
    jump_role: str = "jump_box"
    jump_port: int = 22
    internal_prefix: str = "10."

    @property
    def known_roles(self) -> tuple[str, ...]:
        return (self.web_role, self.jump_role)


_BEACON = {"host": "instanceid", "src": "srcaddr", "dst": "dstaddr"}


def _opened_outbound(flows: DataFrame, internal_prefix: str) -> DataFrame:
    return flows.where(
        F.col("srcaddr").startswith(internal_prefix)
        & ~F.col("dstaddr").startswith(internal_prefix)
        & F.col("tcpflags").isin(*OPENING_FLAGS)
        & (F.col("action") == "ACCEPT")
    )


def aws_beaconing(
    flows: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "4 hours",
    min_count: int = 100,
    max_variance: float = 0.3,
    min_gap: float = 1,
    internal_prefix: str = "10.",
) -> DataFrame:
    """Accepted outbound connections that are opened at regular intervals."""
    outbound = _opened_outbound(timebound(flows, "recorded_at", now, lookback), internal_prefix)
    thresholds = {"min_count": min_count, "max_variance": max_variance, "min_gap": min_gap}
    return beacons(outbound, **_BEACON, start="starttime", end="endtime", **thresholds)


def aws_beacon_hours(flows: DataFrame, internal_prefix: str = "10.", minutes: int = 60) -> DataFrame:
    """What `aws_beaconing` needs to know of each hour, or other span, to be kept: see `beacon_stretches`."""
    outbound = _opened_outbound(flows, internal_prefix)
    return beacon_stretches(outbound, **_BEACON, start="starttime", end="endtime", minutes=minutes)


def aws_beaconing_of(
    hours: DataFrame, min_count: int = 100, max_variance: float = 0.3, min_gap: float = 1
) -> DataFrame:
    """`aws_beaconing` over the hours given, however many."""
    return beacons_of(hours, **_BEACON, min_count=min_count, max_variance=max_variance, min_gap=min_gap)


def aws_listed_flows(
    flows: DataFrame, iocs: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Parsed flows with a listed end: all that `aws_ioc_connections` can report, to be enriched for it."""
    spread_by = ["srcaddr", "dstaddr", "srcport", "dstport", "starttime"]
    return with_listed_end(flows, iocs, "ioc_value", "srcaddr", "dstaddr", spread_by, broadcast_limit)


def aws_ioc_connections(
    flows_ec2: DataFrame,
    iocs: DataFrame,
    policy: RolePolicy = RolePolicy(),
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Opened connections accepted from a listed address, or made to one.

    Listed sources reaching a web server on its port are ignored. The test is null, and
    the source not reported, for an untagged destination on that port.
    """
    expected = (tag(F.col("dst_tags")) == policy.web_role) & (F.col("dstport") == policy.web_port)
    return candidate_join(
        flows_ec2.where(F.col("tcpflags").isin(*OPENING_FLAGS)),
        iocs,
        "ioc_value",
        src="srcaddr",
        dst="dstaddr",
        src_counts=(F.col("action") == "ACCEPT") & ~expected,
        broadcast_limit=broadcast_limit,
    )


def _roles(instances: DataFrame) -> DataFrame:
    return instances.select("instance_id", tag(F.col("tags")).alias("instance_role"))


def aws_reset_counts(flows: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Resets of the last 25 hours per instance and hour, in one pass: `recent` of the last hour, `earlier` of the 24 hours
    before. A flow at the instant between belongs to both.

    Baseline and scan both fold from it, and roles are joined to it, not to flows: an instance with several addresses multiplies
    a row an hour. Keep it (`sources.cut_lineage`) when both are wanted.
    """
    at = F.col("recorded_at")
    border = ago(now, "1 hour")
    return (
        timebound(flows, "recorded_at", now, "25 hours")
        .where(F.col("tcpflags") == RESET_FLAG)
        .groupBy("instanceid", hour_start(at).alias("hour"))
        .agg(F.count_if(at >= border).alias("recent"), F.count_if(at <= border).alias("earlier"))
    )


def _by_role(counts: DataFrame, instances: DataFrame, count: str, keys: list[str]) -> DataFrame:
    """Counts of instances summed by role and `keys`; a row for each instance and address counts."""
    return (
        counts.join(_roles(instances), F.col("instanceid") == F.col("instance_id"))
        .groupBy("instance_role", *keys)
        .agg(F.sum(count).alias(count))
    )


def aws_role_counts(instances: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """How many instances of each role were seen 25 h to 1 h ago."""
    return (
        timebound(instances, "latest_available_data", now, "25 hours", "1 hour")
        .groupBy(tag(F.col("tags")).alias("instance_role"))
        .agg(F.count("*").alias("role_count"))
    )


def aws_rst_baseline_of(counts: DataFrame, instances: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """`aws_rst_baseline` from `aws_reset_counts`."""
    resets = (
        counts.where("earlier > 0")
        .groupBy("instanceid", hour_of_day(F.col("hour")).alias("hourly_part"))
        .agg(F.sum("earlier").alias("resets"))
    )
    rate = F.try_divide(F.col("resets"), F.col("role_count"))
    return (
        _by_role(resets, instances, "resets", ["hourly_part"])
        .join(aws_role_counts(instances, now), "instance_role")
        .groupBy("instance_role")
        .agg(F.avg(rate).alias("avg_rst_by_role"), F.stddev(rate).alias("stddev_rst_by_role"))
        .select("avg_rst_by_role", "stddev_rst_by_role", "instance_role")
    )


def aws_port_scanning_of(counts: DataFrame, instances: DataFrame, baseline: DataFrame, k: float = 1) -> DataFrame:
    """`aws_port_scanning` from `aws_reset_counts`."""
    recent = counts.where("recent > 0").groupBy("instanceid").agg(F.sum("recent").alias("rst_last_hour"))
    limit = F.col("avg_rst_by_role") + k * F.col("stddev_rst_by_role")
    return (
        _by_role(recent, instances, "rst_last_hour", ["instanceid"])
        .join(baseline, "instance_role")
        .where(F.col("rst_last_hour") >= limit)
        .select(
            "rst_last_hour", "instanceid", "instance_role", "avg_rst_by_role", "stddev_rst_by_role"
        )
    )


def aws_rst_baseline(
    flows: DataFrame, instances: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """Per role: mean and deviation over the hours of the day of resets per instance, 25 h to 1 h ago."""
    return aws_rst_baseline_of(aws_reset_counts(flows, now), instances, now)


def aws_port_scanning(
    flows: DataFrame,
    instances: DataFrame,
    baseline: DataFrame,
    now: datetime | Column | None = None,
    k: float = 1,
) -> DataFrame:
    """Instances whose resets of the last hour reach mean + k deviations of their role.

    `baseline` is the output of `aws_rst_baseline`. Instances without a role have
    no baseline and cannot be reported.
    """
    return aws_port_scanning_of(aws_reset_counts(flows, now), instances, baseline, k)


def aws_hourly_resets(flows: DataFrame, instances: DataFrame) -> DataFrame:
    """Resets per role and hour, for a baseline that rolls (`plans.RollingBaseline`)."""
    resets = (
        flows.where(F.col("tcpflags") == RESET_FLAG)
        .groupBy("instanceid", hour_start(F.col("recorded_at")).alias("hour"))
        .agg(F.count("*").alias("n"))
    )
    return _by_role(resets, instances, "n", ["hour"])


def aws_rst_baseline_of_moments(
    moments: DataFrame, instances: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """`aws_rst_baseline` from the moments of hourly resets by role."""
    return moments.join(aws_role_counts(instances, now), "instance_role").select(
        mean(F.col("role_count")).alias("avg_rst_by_role"),
        deviation(F.col("role_count")).alias("stddev_rst_by_role"),
        "instance_role",
    )


def web_server_initiates(policy: RolePolicy) -> Column:
    return tag(F.col("src_tags")) == policy.web_role


def jump_box_off_port(policy: RolePolicy) -> Column:
    return (tag(F.col("src_tags")) == policy.jump_role) & (F.col("dstport") != policy.jump_port)


def outsider_on_web_server_off_port(policy: RolePolicy) -> Column:
    return (
        (tag(F.col("dst_tags")) == policy.web_role)
        & (F.col("action") == "ACCEPT")
        & (F.col("dstport") != policy.web_port)
        & ~F.col("srcaddr").startswith(policy.internal_prefix)
    )


def insider_without_known_role(policy: RolePolicy) -> Column:
    role = tag(F.col("src_tags"))
    return F.col("srcaddr").startswith(policy.internal_prefix) & (
        role.isNull() | ~role.isin(*policy.known_roles)
    )


def aws_unusual_role_ports(flows_ec2: DataFrame, policy: RolePolicy = RolePolicy()) -> DataFrame:
    """Opened connections that break one of the four rules of the role policy."""
    broken = (
        web_server_initiates(policy)
        | jump_box_off_port(policy)
        | outsider_on_web_server_off_port(policy)
        | insider_without_known_role(policy)
    )
    return flows_ec2.where(F.col("tcpflags").isin(*OPENING_FLAGS) & broken)
