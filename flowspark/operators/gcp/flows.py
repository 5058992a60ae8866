"""VPC flow logs, delivered among the audit logs, and their join to VMs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import parse_once, partition_day, timebound
from flowspark.operators.joins import BROADCAST_LIMIT_BYTES, both_ends_join, is_small

FLOW_LOG = "compute.googleapis.com/vpc_flows"
_SPREAD_BY = ["src_ip", "dst_ip", "src_port", "dst_port", "start_time"]


def gcp_flow_logs(
    audit_logs: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "1 hour",
) -> DataFrame:
    """Flow entries of the look-back, parsed once and typed. Best written out on ingest."""
    r = F.col("record")
    payload = r["jsonPayload"]
    source, destination = payload["src_instance"], payload["dest_instance"]
    connection = payload["connection"]
    entries = timebound(audit_logs, "recorded_at", now, lookback).where(F.col("log_type") == FLOW_LOG)
    return (
        parse_once(entries, "raw", schemas.GCP_FLOW_RECORD, "record")
        .select(
            "recorded_at",
            F.try_to_timestamp(r["timestamp"]).alias("event_time"),
            F.try_to_timestamp(payload["start_time"]).alias("start_time"),
            F.try_to_timestamp(payload["end_time"]).alias("end_time"),
            F.col("id").alias("log_id"),
            "deployment",
            "account",
            r["insertId"].alias("insert_id"),
            connection["dest_ip"].alias("dst_ip"),
            connection["dest_port"].try_cast("int").alias("dst_port"),
            connection["src_ip"].alias("src_ip"),
            connection["src_port"].try_cast("int").alias("src_port"),
            connection["protocol"].try_cast("int").alias("protocol"),
            payload["bytes_sent"].try_cast("bigint").alias("bytes"),
            payload["packets_sent"].try_cast("bigint").alias("packets"),
            destination["project_id"].alias("dst_project"),
            destination["region"].alias("dst_region"),
            destination["vm_name"].alias("dst_vm_name"),
            destination["zone"].alias("dst_zone"),
            payload["dest_vpc"]["subnetwork_name"].alias("dst_subnet_name"),
            source["project_id"].alias("src_project"),
            source["region"].alias("src_region"),
            source["vm_name"].alias("src_vm_name"),
            source["zone"].alias("src_zone"),
            payload["src_vpc"]["subnetwork_name"].alias("src_subnet_name"),
            payload["reporter"].alias("reporter"),
            "raw",
            *partition_day(audit_logs),
        )
    )


def gcp_flow_logs_join_vms(
    flows: DataFrame, vms: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Flows with tags and interfaces of the VM at each end, by VM name.

    `vms` is measured, and broadcast up to `broadcast_limit` bytes. Beyond, only flows between two VMs are shuffled twice.
    """
    described = vms.select("vm_name", "tags", "nics")
    ends = {"src_": "src_vm_name", "dst_": "dst_vm_name"}
    return both_ends_join(flows, described, ends, "vm_name", _SPREAD_BY, is_small(described, broadcast_limit))
