"""Virtual machines and network interfaces (NICs) with the time each one lived."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import (
    as_json,
    canonical_json,
    document,
    explode_parsed,
    field,
    nth,
)
from flowspark.functions.tags import TAG_MAP
from flowspark.operators.joins import next_start
from flowspark.operators.parts import (
    EntityView,
    Part,
    counted,
    digest_of,
    payload_part,
    repeated,
    with_payload,
)


def _body(path: str) -> Column:
    """A field of the resource described in an activity log entry's response."""
    return field(F.col("body"), path)


def _created(activity_logs: DataFrame) -> DataFrame:
    """Entries with the entity they name and the resource of their response as a document `body`."""
    doc = F.col("doc")
    return (
        activity_logs.withColumn("doc", document(F.col("properties")))
        .withColumn("entity", field(doc, "$.entity"))
        .withColumn("body", document(field(doc, "$.responseBody")))
    )


def _tenant() -> Column:
    return field(document(F.col("raw")), "$.tenantId").alias("tenant_id")


def _nic_creations(activity_logs: DataFrame) -> DataFrame:
    return _created(
        activity_logs.where(
            (F.col("operation_name") == "MICROSOFT.NETWORK/NETWORKINTERFACES/WRITE")
            & (F.col("result_signature") == "Succeeded.Created")
        )
    )


def _logged_nics(activity_logs: DataFrame) -> DataFrame:
    """NICs of creation events."""
    return _nic_creations(activity_logs).select(
        _tenant(),
        nth(F.col("entity"), "/", 2).alias("subscription_id"),
        F.col("entity").alias("nic_id"),
        _body("$.name").alias("nic_name"),
        _body("$.location").alias("nic_location"),
        _body("$.properties").alias("payload"),
        _body("$.tags").alias("nic_tags"),
        _body("$.type").alias("type"),
        F.lit("operation_logs").alias("source"),
        F.col("event_time").alias("earliest"),
        F.col("recorded_at").alias("at"),
    )


def _collected_nics(nic_inventory: DataFrame) -> DataFrame:
    """NICs of inventory snapshots."""
    return nic_inventory.select(
        "tenant_id",
        "subscription_id",
        F.col("id").alias("nic_id"),
        F.col("name").alias("nic_name"),
        F.col("location").alias("nic_location"),
        F.col("properties").alias("payload"),
        canonical_json(F.col("tags")).alias("nic_tags"),
        "type",
        F.lit("collect_script").alias("source"),
        F.col("recorded_at").alias("earliest"),
        F.col("recorded_at").alias("at"),
    )


_NIC_IPS = "array<variant>"
# The id comes first: versions are then sorted by it, and what chooses among those of a NIC sorts no second time.
_NIC_LOWERED = ("nic_id", "tenant_id", "subscription_id", "nic_name", "nic_location", "type")
_NIC_VERSION = (*_NIC_LOWERED, "nic_tags", "source", "digest", "ip_number", "private_ip", "primary")


def _seen_nics(activity_logs: DataFrame, nic_inventory: DataFrame) -> DataFrame:
    return _collected_nics(nic_inventory).unionByName(_logged_nics(activity_logs))


def _nic_sightings(activity_logs: DataFrame, nic_inventory: DataFrame) -> DataFrame:
    """One row per IP configuration of a sighted NIC; a NIC without any is one row, which still dates it.

    Versions go by the digest of their properties in canonical form; `found_as` is that of the text they came in.
    """
    seen = _seen_nics(activity_logs, nic_inventory).where(F.col("nic_id").isNotNull())
    ip = F.col("ip")
    return (
        seen.withColumns({c: F.lower(c) for c in _NIC_LOWERED})
        .withColumn("doc", document(F.col("payload")))
        .withColumn("digest", digest_of(F.nullif(as_json(F.col("doc")), F.lit("null"))))
        .withColumn("found_as", digest_of(F.col("payload")))
        .select("*", F.posexplode_outer(field(F.col("doc"), "$.ipConfigurations", _NIC_IPS)).alias("ip_number", "ip"))
        .withColumn("private_ip", field(ip, "$.properties.privateIPAddress"))
        .withColumn("primary", F.coalesce(field(ip, "$.properties.primary", "boolean"), F.lit(False)))
        .withColumn("ip_number", F.when(ip.isNotNull(), F.col("ip_number")))
        .drop("ip", "doc", "payload")
    )


def _nic_payloads(activity_logs: DataFrame, nic_inventory: DataFrame) -> DataFrame:
    return _seen_nics(activity_logs, nic_inventory).select("at", "payload").where("payload is not null")


def _nic_deletions(activity_logs: DataFrame) -> DataFrame:
    return activity_logs.where(
        (F.col("operation_name") == "MICROSOFT.NETWORK/NETWORKINTERFACES/DELETE")
        & (F.col("result_signature") == "Succeeded.")
        & (F.col("result_type") == "Success")
    ).select(
        F.lower(field(document(F.col("properties")), "$.entity")).alias("deleted_nic"),
        F.col("event_time").alias("deleted_at"),
        F.col("recorded_at").alias("at"),
        F.lit(1).cast("bigint").alias("times"),
    )


_NIC_SOURCES = ("azure_logs", "azure_collect_network_interfaces")
NIC_SIGHTINGS = Part(
    "azure_nic_sightings",
    _NIC_SOURCES,
    _nic_sightings,
    _NIC_VERSION,
    lambda: [F.min("earliest").alias("earliest"), F.max("found_as").alias("found_as")],
)
NIC_DELETIONS = Part("azure_nic_deletions", ("azure_logs",), _nic_deletions, ("deleted_nic", "deleted_at"), counted)
NIC_PROPERTIES = payload_part("azure_nic_properties", _NIC_SOURCES, _nic_payloads)


def _nics(sightings: DataFrame, deletions: DataFrame, properties: DataFrame, keep_all_ips: bool = False) -> DataFrame:
    ranked = F.struct(
        F.col("nic_tags").isNull().alias("untagged"),
        "nic_tags",
        "primary",
        "source",
        "earliest",
        "private_ip",
        "ip_number",
        "digest",
        "found_as",
        *[c for c in _NIC_LOWERED if c != "nic_id"],
    )
    keys = ["nic_id", "private_ip"] if keep_all_ips else ["nic_id"]
    best = sightings.groupBy(*keys).agg(
        F.min("earliest").alias("window_start"),
        F.max(F.when(F.col("ip_number").isNotNull(), ranked)).alias("best"),
    )
    if keep_all_ips:
        best = best.drop("private_ip").withColumn(
            "window_start", F.min("window_start").over(Window.partitionBy("nic_id"))
        )
    nics = (
        best.where(F.col("best").isNotNull())
        .select("nic_id", "window_start", "best.*")
        .drop("untagged", "primary", "digest")
    )
    followed = next_start(nics, "private_ip", "earliest", ["nic_id", "ip_number"], "window_start", "next_start")
    ended = followed.join(repeated(deletions), F.col("nic_id") == F.col("deleted_nic"), "left")
    doc = F.col("doc")
    described = with_payload(ended, properties, "payload", "found_as").withColumn("doc", document(F.col("payload")))
    ips = field(doc, "$.ipConfigurations", _NIC_IPS)
    return described.select(
        "tenant_id",
        "subscription_id",
        "nic_id",
        "nic_name",
        "nic_location",
        as_json(doc).alias("nic_properties"),
        F.from_json("nic_tags", TAG_MAP).alias("nic_tags"),
        "type",
        "source",
        "earliest",
        as_json(F.get(ips, F.col("ip_number"))).alias("ip_configuration"),
        "private_ip",
        "window_start",
        F.coalesce("deleted_at", "next_start").alias("window_end"),
    )


NICS = EntityView(_nics, (NIC_SIGHTINGS, NIC_DELETIONS, NIC_PROPERTIES))


def azure_nics(
    activity_logs: DataFrame,
    nic_inventory: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "30 days",
    keep_all_ips: bool = False,
) -> DataFrame:
    """NICs seen in creation events and inventory: one row per NIC (per NIC and IP with `keep_all_ips`).

    Of several versions of a NIC the one with the greatest tags is kept, no tags
    ranking first; ties go to the primary IP configuration, then to the later source name, the later first sighting, the greatest
    address. The choice is an aggregate, combined before the shuffle, not a sort of all versions; properties are
    fetched by the digest of their text at the end, and the IP configuration is read from them.
    """
    both = (activity_logs, nic_inventory)
    return _nics(
        NIC_SIGHTINGS.recent(both, now, lookback),
        NIC_DELETIONS.recent([activity_logs], now, lookback),
        NIC_PROPERTIES.recent(both, now, lookback),
        keep_all_ips,
    )


def _vm_creations(activity_logs: DataFrame) -> DataFrame:
    return _created(
        activity_logs.where(
            (F.col("operation_name") == "MICROSOFT.COMPUTE/VIRTUALMACHINES/WRITE")
            & (F.col("category") == "Write")
            & (F.col("result_signature") == "Accepted.Created")
        )
    )


def _seen_vms(activity_logs: DataFrame, vm_inventory: DataFrame) -> DataFrame:
    collected = vm_inventory.select(
        canonical_json(F.col("tags")).alias("tags"),
        "tenant_id",
        "subscription_id",
        F.lower("id").alias("vm_id"),
        "location",
        F.col("name").alias("vm_name"),
        F.col("properties").alias("payload"),
        F.lit("inventory").alias("source"),
        "recorded_at",
    )
    logged = _vm_creations(activity_logs).select(
        _body("$.tags").alias("tags"),
        _tenant(),
        nth(_body("$.id"), "/", 2).alias("subscription_id"),
        F.lower(_body("$.id")).alias("vm_id"),
        _body("$.location").alias("location"),
        _body("$.properties.osProfile.computerName").alias("vm_name"),
        _body("$.properties").alias("payload"),
        F.lit("events").alias("source"),
        "recorded_at",
    )
    return collected.unionByName(logged)


def _vm_sightings(activity_logs: DataFrame, vm_inventory: DataFrame) -> DataFrame:
    seen = _seen_vms(activity_logs, vm_inventory).where(F.col("vm_id").isNotNull())
    times = {name: F.col("recorded_at") for name in ("at", "earliest", "latest")}
    digests = {"digest": digest_of(canonical_json(F.col("payload"))), "found_as": digest_of(F.col("payload"))}
    return seen.withColumns({**times, **digests}).drop("payload", "recorded_at")


def _vm_payloads(activity_logs: DataFrame, vm_inventory: DataFrame) -> DataFrame:
    seen = _seen_vms(activity_logs, vm_inventory)
    return seen.select(F.col("recorded_at").alias("at"), "payload").where("payload is not null")


def _vm_deletions(activity_logs: DataFrame) -> DataFrame:
    return activity_logs.where(
        (F.col("operation_name") == "MICROSOFT.COMPUTE/VIRTUALMACHINES/DELETE")
        & (F.col("category") == "Delete")
        & (F.col("result_signature") == "Succeeded.")
        & (F.col("result_type") == "Success")
    ).select(
        F.lower("resource_id").alias("deleted_vm"),
        F.col("event_time").alias("deleted_at"),
        F.col("recorded_at").alias("at"),
    )


_VM_SOURCES = ("azure_logs", "azure_collect_virtual_machines")
_VM_IDENTITY = ("tags", "tenant_id", "subscription_id", "vm_id", "location", "vm_name", "digest")
# One grouping per source: a version in both keeps two rows, each with its own latest time.
VM_SIGHTINGS = Part(
    "azure_vm_sightings",
    _VM_SOURCES,
    _vm_sightings,
    (*_VM_IDENTITY, "source"),
    lambda: [F.max("latest").alias("latest"), F.min("earliest").alias("earliest"), F.max("found_as").alias("found_as")],
)
VM_DELETIONS = Part("azure_vm_deletions", ("azure_logs",), _vm_deletions, ("deleted_vm", "deleted_at"))
VM_PROPERTIES = payload_part("azure_vm_properties", _VM_SOURCES, _vm_payloads)


def _vms(sightings: DataFrame, deletions: DataFrame, properties: DataFrame) -> DataFrame:
    versions = sightings.withColumn("window_start", F.min("earliest").over(Window.partitionBy("vm_id")))
    ended = (
        versions.join(deletions, F.col("vm_id") == F.col("deleted_vm"), "left")
        .groupBy("window_start", F.coalesce("deleted_at", "latest").alias("window_end"), *_VM_IDENTITY)
        .agg(F.max("found_as").alias("found_as"))
    )
    return with_payload(ended, properties, "payload", "found_as").select(
        "window_start",
        "window_end",
        "tenant_id",
        "subscription_id",
        "vm_id",
        "vm_name",
        canonical_json(F.col("payload")).alias("properties"),
        "location",
        F.from_json("tags", TAG_MAP).alias("tags"),
    )


VMS = EntityView(_vms, (VM_SIGHTINGS, VM_DELETIONS, VM_PROPERTIES))


def azure_vms(
    activity_logs: DataFrame,
    vm_inventory: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "30 days",
) -> DataFrame:
    """VMs seen in creation events and inventory: one row per distinct version, with its lifetime.

    Sightings are grouped by version first, with their first and last time; the first sighting of a VM is then the least
    of its few versions. A digest stands for the properties until the end.
    """
    both = (activity_logs, vm_inventory)
    return _vms(
        VM_SIGHTINGS.recent(both, now, lookback),
        VM_DELETIONS.recent([activity_logs], now, lookback),
        VM_PROPERTIES.recent(both, now, lookback),
    )


def azure_vms_nics(vms: DataFrame, nics: DataFrame) -> DataFrame:
    """One row per (VM, NIC): the VM's columns as `vm_*`, the NIC's under their own names."""
    attached = field(
        document(F.col("properties")), "$.networkProfile.networkInterfaces", "array<struct<id: string>>"
    )
    per_nic = explode_parsed(vms, attached, "attached").select(
        F.col("window_start").alias("vm_window_start"),
        F.col("window_end").alias("vm_window_end"),
        F.col("tags").alias("vm_tags"),
        F.col("tenant_id").alias("vm_tenant_id"),
        F.col("subscription_id").alias("vm_subscription_id"),
        "vm_id",
        F.col("location").alias("vm_location"),
        "vm_name",
        F.col("properties").alias("vm_properties"),
        F.lower("attached.id").alias("vm_nic_id"),
    )
    return per_nic.join(nics, F.col("vm_nic_id") == F.lower("nic_id"))


VMS_NICS = EntityView(azure_vms_nics, (), ("azure_vms", "azure_nics"))
