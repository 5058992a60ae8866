"""VMs with the time each one lived."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import canonical_json, parse_once, tags_to_map, timebound
from flowspark.functions.tags import TAG_MAP
from flowspark.operators.parts import EntityView, Part, counted, repeated

ACTIVITY_LOG = "cloudaudit.googleapis.com/activity"
# Fixed value: what stands before the resource path in an asset name.
ASSET_HOST = "//compute.googleapis.com/"


def _activity(audit_logs: DataFrame) -> DataFrame:
    """Instance activity entries, parsed."""
    activity = audit_logs.where(F.col("log_type") == ACTIVITY_LOG)
    return parse_once(activity, "raw", schemas.GCP_AUDIT_RECORD, "record").where(
        F.col("record.resource.type") == "gce_instance"
    )


def _created(audit_logs: DataFrame) -> DataFrame:
    """Creation events. They do not tell the interfaces."""
    request = F.col("record.protoPayload.request")
    tags = tags_to_map(request["labels"], "key", "value")
    return (
        _activity(audit_logs)
        .where(F.col("record.protoPayload.response.operationType") == "insert")
        .select(
            "account",
            "recorded_at",
            request["name"].alias("vm_name"),
            F.col("record.resource.labels.project_id").alias("project_name"),
            F.col("record.resource.labels.zone").alias("zone"),
            F.col("record.protoPayload.resourceName").alias("resource_name"),
            canonical_json(F.to_json(tags)).alias("tags"),
            F.lit(None).cast("string").alias("nics"),
            F.try_to_timestamp("record.protoPayload.response.startTime").alias("start_time"),
        )
    )


def _snapshots(assets: DataFrame) -> DataFrame:
    """Instances of asset inventory snapshots; names come from the asset's path."""
    data = F.col("record.resource.data")
    name = F.col("record.name")
    snapshots = assets.where(F.col("log_type") == "cloudassets")
    return (
        parse_once(snapshots, "raw", schemas.GCP_ASSET_RECORD, "record")
        .where(F.col("record.asset_type") == "compute.googleapis.com/Instance")
        .select(
            "account",
            "recorded_at",
            F.split_part(name, F.lit("/"), F.lit(-1)).alias("vm_name"),
            F.split_part(name, F.lit("/"), F.lit(5)).alias("project_name"),
            F.col("record.resource.location").alias("zone"),
            F.substr(name, F.lit(len(ASSET_HOST) + 1)).alias("resource_name"),
            canonical_json(F.to_json(data["labels"])).alias("tags"),
            canonical_json(data["networkInterfaces"]).alias("nics"),
            F.try_to_timestamp(data["creationTimestamp"]).alias("start_time"),
        )
    )


def _sighted(rows: DataFrame) -> DataFrame:
    known = rows.where(F.col("resource_name").isNotNull())
    return known.withColumns({"at": F.col("recorded_at"), "first": F.least("recorded_at", "start_time")})


def _deletions(audit_logs: DataFrame) -> DataFrame:
    record = F.col("record.protoPayload")
    return (
        _activity(audit_logs)
        .where((record["methodName"] == "v1.compute.instances.delete") & (record["response"]["operationType"] == "delete"))
        .select(
            record["resourceName"].alias("deleted_resource"),
            F.try_to_timestamp("record.receiveTimestamp").alias("term_time"),
            F.col("recorded_at").alias("at"),
            F.lit(1).cast("bigint").alias("times"),
        )
    )


_DESCRIBED = ("account", "vm_name", "project_name", "zone", "tags")
_SEEN = ("resource_name", "recorded_at", "nics")


def _least() -> list[Column]:
    return [F.min(c).alias(c) for c in ("start_time", "first", *_DESCRIBED)]


CREATIONS = Part("gcp_vm_creations", ("gcp_audit_logs",), lambda logs: _sighted(_created(logs)), _SEEN, _least)
SNAPSHOTS = Part(
    "gcp_vm_snapshots", ("gcp_cloud_assets",), lambda assets: _sighted(_snapshots(assets)), _SEEN, _least, lookback="3 days"
)
DELETIONS = Part("gcp_vm_deletions", ("gcp_audit_logs",), _deletions, ("deleted_resource", "term_time"), counted)


def _vms(sightings: DataFrame, deletions: DataFrame) -> DataFrame:
    vm = ["true_earliest", "true_latest", "resource_name"]
    of_vm = Window.partitionBy("resource_name")
    sightings = (
        sightings.withColumn("true_latest", F.max("recorded_at").over(of_vm))
        .withColumn("true_earliest", F.min("first").over(of_vm))
        .where(F.col("recorded_at") == F.col("true_latest"))
    )
    vms = sightings.groupBy(*vm, *_DESCRIBED).agg(
        F.min("start_time").alias("start_time"), F.max("nics").alias("nics")
    )
    return vms.join(
        repeated(deletions), F.col("resource_name") == F.col("deleted_resource"), "left"
    ).select(
        "account",
        "vm_name",
        "project_name",
        "zone",
        "resource_name",
        F.from_json("tags", TAG_MAP).alias("tags"),
        "nics",
        F.least("start_time", "true_earliest").alias("earliest"),
        F.greatest("true_latest", F.coalesce("term_time", "true_latest")).alias("last_seen"),
        "term_time",
    )


def _vms_of_parts(creations: DataFrame, snapshots: DataFrame, deletions: DataFrame) -> DataFrame:
    return _vms(CREATIONS.fold(creations.unionByName(snapshots)), deletions)


VMS = EntityView(_vms_of_parts, (CREATIONS, SNAPSHOTS, DELETIONS))


def gcp_vms(
    audit_logs: DataFrame,
    assets: DataFrame,
    now: datetime | Column | None = None,
    create_lookback: str | timedelta = "30 days",
    snapshot_lookback: str | timedelta = "3 days",
) -> DataFrame:
    """VMs seen in creation events and asset snapshots, as of their latest sighting.

    Sightings are grouped by VM, time and interfaces first; the first and latest sighting of a VM then come from these few
    rows, of which only the latest stay. So each source is scanned and parsed once, and the log once more for deletions.
    """
    created = CREATIONS.rows(timebound(audit_logs, "recorded_at", now, create_lookback))
    collected = SNAPSHOTS.rows(timebound(assets, "recorded_at", now, snapshot_lookback))
    return _vms(CREATIONS.fold(created.unionByName(collected)), DELETIONS.recent([audit_logs], now, create_lookback))
