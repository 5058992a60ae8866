"""Network security group flow logs and their join to VMs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import explode_parsed, is_distinct, nth, partition_day, text_or_null
from flowspark.operators.joins import (
    BROADCAST_LIMIT_BYTES,
    both_lifetimes_join,
    id_join,
    is_small,
    lifetime_join,
    merge_lifetimes,
    size_by,
)

# The one-letter codes of a flow tuple.
PROTOCOLS = {"t": "TCP", "u": "UDP"}
DIRECTIONS = {"i": "INBOUND", "o": "OUTBOUND"}
DECISIONS = {"a": "ALLOWED", "d": "DENIED"}
STATES = {"b": "BEGIN", "c": "CONTINUING", "e": "END"}


def _decoded(code: Column, names: dict[str, str]) -> Column:
    name = F.lit(None).cast("string")
    for letter, meaning in reversed(names.items()):
        name = F.when(code == letter, meaning).otherwise(name)
    return name


def azure_flow_logs(raw: DataFrame) -> DataFrame:
    """Nested flow records to one row per flow tuple.

    The record is parsed once; rules, MAC groups and tuples are exploded in turn,
    without a shuffle. `properties`, `flow_raw` (the rule) and `flow_tuples` (the MAC group) are
    JSON text, written only when they are selected.
    """
    dated = partition_day(raw)
    parsed = raw.select("recorded_at", *dated, F.from_json("flow_raw", schemas.AZURE_FLOW_RECORD).alias("record"))
    rules = explode_parsed(parsed, F.col("record.properties.flows"), "rule_flows")
    groups = rules.select("*", F.explode("rule_flows.flows").alias("mac_flows"))
    tuples = groups.select(
        "*", F.explode(F.coalesce("mac_flows.flow_tuples", "mac_flows.flowTuples")).alias("raw_flow")
    ).withColumn("parts", F.split("raw_flow", ","))

    def part(index: int) -> Column:
        return F.get("parts", F.lit(index))

    def number(index: int, kind: str) -> Column:
        # Empty counters are common, and a cast that fails is slow.
        text = F.trim(part(index))
        return F.when(text != "", text.try_cast(kind))

    def code(index: int, names: dict[str, str]) -> Column:
        return _decoded(text_or_null(part(index)), names)

    return tuples.select(
        "recorded_at",
        F.col("record.category").alias("category"),
        F.col("record.macAddress").alias("mac_address"),
        F.col("record.operationName").alias("operation_name"),
        F.to_json("record.properties").alias("properties"),
        F.col("record.resourceId").alias("resource_id"),
        F.col("record.systemId").alias("system_id"),
        F.try_to_timestamp("record.time").alias("time_stamp"),
        F.to_json("rule_flows").alias("flow_raw"),
        F.col("rule_flows.rule").alias("rule"),
        F.to_json("mac_flows").alias("flow_tuples"),
        F.col("mac_flows.mac").alias("flow_mac"),
        "raw_flow",
        F.timestamp_seconds(number(0, "bigint")).alias("event_time"),
        part(1).alias("src_addr"),
        part(2).alias("dst_addr"),
        number(3, "int").alias("src_port"),
        number(4, "int").alias("dst_port"),
        code(5, PROTOCOLS).alias("protocol"),
        code(6, DIRECTIONS).alias("traffic_flow"),
        code(7, DECISIONS).alias("traffic_decision"),
        code(8, STATES).alias("flow_state"),
        number(9, "bigint").alias("packets_src_to_dst"),
        number(10, "bigint").alias("bytes_src_to_dst"),
        number(11, "bigint").alias("packets_dst_to_src"),
        number(12, "bigint").alias("bytes_dst_to_src"),
        *dated,
    )


# What tells enriched flows apart, besides the time of recording.
_FLOW_COLUMNS = [
    "time_stamp",
    "event_time",
    "mac_address",
    "resource_id",
    "rule",
    "src_addr",
    "dst_addr",
    "src_port",
    "dst_port",
    "protocol",
    "traffic_flow",
    "traffic_decision",
    "flow_state",
    "packets_src_to_dst",
    "bytes_src_to_dst",
    "packets_dst_to_src",
    "bytes_dst_to_src",
]
_NIC_COLUMNS = ["nic_id", "nic_name", "nic_location", "nic_properties", "nic_tags", "ip_configuration"]
_VM_COLUMNS = ["vm_tags", "vm_id", "vm_name", "vm_properties"]
_SPREAD_BY = ["src_addr", "dst_addr", "src_port", "dst_port", "event_time"]


_PAYLOAD = [*_NIC_COLUMNS, *_VM_COLUMNS]
# JSON text, which takes no part in the joins by address and time.
_LATE = ["nic_properties", "ip_configuration", "vm_properties"]


def azure_lifetimes(vms_nics: DataFrame) -> DataFrame:
    """The entities of `azure_vms_nics`, each distinct payload once per stretch of its lifetime and subscription.

    A digest (`digest`) stands for the payload while lifetimes are merged, and each payload is fetched once at the end. Keep
    this view (`sources.cut_lineage`): the join of flows to it reads it several times.
    """
    described = vms_nics.withColumn("digest", F.sha2(F.to_json(F.struct(*_PAYLOAD)), 256))
    spans = described.select("digest", "private_ip", "subscription_id", "window_start", "window_end")
    merged = merge_lifetimes(spans, ["digest", "private_ip", "subscription_id"], "window_start", "window_end")
    return _described(merged, described)


def _described(spans: DataFrame, described: DataFrame) -> DataFrame:
    """Lifetimes of digests with what the digests stand for."""
    payloads = described.groupBy(F.col("digest").alias("_digest")).agg(
        *[F.first(c).alias(c) for c in _PAYLOAD if c in described.columns]
    )
    return spans.join(payloads, F.col("digest") == F.col("_digest")).drop("_digest")


def _side(lifetimes: DataFrame, side: str, by_subscription: bool) -> DataFrame:
    """The entities as one end of a flow. Without its subscription a payload may have stretches that overlap: they are joined.

    The digest stands for JSON text, see `_with_late`.
    """
    lifetimes = lifetimes.drop(*_LATE)
    if not by_subscription:
        spans = lifetimes.select("digest", "private_ip", "window_start", "window_end")
        lifetimes = _described(merge_lifetimes(spans, ["digest", "private_ip"], "window_start", "window_end"), lifetimes)
    renamed = {c: f"{side}_{c}" for c in lifetimes.columns}
    return lifetimes.withColumnsRenamed({**renamed, "private_ip": f"{side}_ip_addr"})


def _with_late(joined: DataFrame, lifetimes: DataFrame, side: str, small: bool) -> DataFrame:
    """The JSON text of one end by its digest, which is unique: the optimizer leaves the join out where nobody asks for it."""
    late = lifetimes.groupBy(F.col("digest").alias(f"_{side}_digest")).agg(*[F.first(c).alias(f"{side}_{c}") for c in _LATE])
    return id_join(joined, late, f"{side}_digest", f"_{side}_digest", _SPREAD_BY, small)


def _same_subscription(source: Column, prefix: str = "") -> Column:
    return F.col("_subscription") == source[f"{prefix}subscription_id"]


def _joined_side_by_side(distinct_flows: DataFrame, lifetimes: DataFrame, broadcast_limit: int, common: dict) -> DataFrame:
    """One end after the other, by lifetimes that are broadcast."""

    def ends(side: str) -> dict[str, str]:
        return {
            "left_ip": f"{side}_addr",
            "right_ip": f"{side}_ip_addr",
            "right_start": f"{side}_window_start",
            "right_end": f"{side}_window_end",
            "broadcast_limit": broadcast_limit,
        }

    with_source = lifetime_join(
        distinct_flows,
        _side(lifetimes, "src", by_subscription=True),
        condition=lambda source: _same_subscription(source, "src_"),
        **ends("src"),
        **common,
    )
    return lifetime_join(with_source, _side(lifetimes, "dst", by_subscription=False), **ends("dst"), **common)


def azure_flow_logs_join_lifetimes(
    flows: DataFrame, lifetimes: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """`azure_flow_logs_join_vm_nics` over `azure_lifetimes`, which are measured, and broadcast up to `broadcast_limit` bytes."""
    dated = partition_day(flows)
    chosen = flows.select(F.col("recorded_at").alias("flow_recorded_at"), *_FLOW_COLUMNS, *dated)
    chosen = chosen.withColumn("_subscription", F.lower(nth(F.col("resource_id"), "/", 2)))
    distinct = is_distinct(flows, ["recorded_at", *_FLOW_COLUMNS])
    size = size_by(lifetimes.drop(*_LATE), "private_ip")
    common = {"left_time": "event_time", "spread_by": _SPREAD_BY, "size": size}
    if size.total <= broadcast_limit:
        with_both = _joined_side_by_side(chosen if distinct else chosen.distinct(), lifetimes, broadcast_limit, common)
    else:
        with_both = both_lifetimes_join(
            chosen,
            lifetimes.drop(*_LATE).withColumnRenamed("private_ip", "ip_addr"),
            ends={"src": "src_addr", "dst": "dst_addr"},
            right_ip="ip_addr",
            right_start="window_start",
            right_end="window_end",
            identity="digest",
            condition=_same_subscription,
            distinct=distinct,
            **common,
        )
    small = is_small(lifetimes, broadcast_limit)
    for side in ("src", "dst"):
        with_both = _with_late(with_both, lifetimes, side, small)
    return with_both.select(
        "flow_recorded_at",
        *_FLOW_COLUMNS,
        *[
            f"{side}_{c}"
            for side in ("src", "dst")
            for c in (*_NIC_COLUMNS, "ip_addr", *_VM_COLUMNS)
        ],
        *dated,
    )


def azure_flow_logs_join_vm_nics(
    flows: DataFrame, vms_nics: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Distinct flows with the VM and NIC at both ends, by address and time.

    The source must also be in the subscription of the reporting resource. The result is distinct
    because both inputs are: flows are made distinct on their own narrow columns, unless their table says that they
    are (`materialize(distinct=..)`), and entities are merged so that a time meets each payload at most once. So
    no payload is ever a shuffle key of the flows. Give kept entities, or kept `azure_lifetimes` to
    `azure_flow_logs_join_lifetimes`, as they are read several times.
    """
    return azure_flow_logs_join_lifetimes(flows, azure_lifetimes(vms_nics), broadcast_limit)
