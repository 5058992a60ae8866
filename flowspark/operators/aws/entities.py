"""EC2 instances and network interfaces with the time each one lived."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions import (
    as_json,
    day_index,
    document,
    explode_parsed,
    field,
    launch_instant,
    tags_to_map,
)
from flowspark.functions.tags import TAG_LIST, TAG_MAP
from flowspark.operators.joins import next_start
from flowspark.operators.parts import EntityView, Part, digest_of, payload_part, with_payload

# Who asked for a network interface tells what it is attached to.
# Rules are tried in this order: column, how it is compared, value, type.
INTERFACE_TYPE_RULES = [
    ("source_ip_address", "is", "elasticloadbalancing.amazonaws.com", "network_load_balancer"),
    ("source_ip_address", "is", "ecs.amazonaws.com", "ecs"),
    ("request_description", "starts", "aws-K8S-", "eks"),
    ("user_identity_invokedby", "is", "elasticfilesystem.amazonaws.com", "efs"),
    ("user_identity_invokedby", "is", "eks.amazonaws.com", "eks"),
    ("user_identity_invokedby", "is", "rds.amazonaws.com", "rds"),
    ("user_identity_invokedby", "is", "clientvpn.amazonaws.com", "clientvpn"),
    ("user_identity_invokedby", "is", "elasticmapreduce.amazonaws.com", "emr"),
    ("user_identity_invokedby", "is", "transitgateway.amazonaws.com", "transitgateway"),
    ("user_identity_invokedby", "is", "redshift.amazonaws.com", "redshift"),
    ("user_identity_invokedby", "is", "es.amazonaws.com", "elasticsearch"),
    ("source_ip_address", "is", "apigateway.amazonaws.com", "apigateway"),
    ("user_identity_principal_id", "ends", ":AmazonSageMaker", "sagemaker"),
    ("request_description", "starts", "AWS Lambda VPC ENI-", "lambda"),
]

NETWORK_INTERFACES = "array<struct<privateIpAddress: string, networkInterfaceId: string>>"


def _snapshots(config: DataFrame) -> DataFrame:
    return config.where(F.col("resource_type") == "AWS::EC2::Instance")


def _config_sightings(config: DataFrame) -> DataFrame:
    """One row per interface of each recorded instance configuration."""
    doc = F.col("doc")
    tags = F.coalesce(
        tags_to_map(field(doc, "$.Tags", TAG_LIST), "Key", "Value"),
        tags_to_map(field(doc, "$.tags", TAG_LIST), "key", "value"),
    )
    launched = F.coalesce(field(doc, "$.LaunchTime"), field(doc, "$.launchTime"))
    snapshots = (
        _snapshots(config)
        .withColumn("doc", document(F.col("configuration")))
        .select(
            "account_id",
            F.col("resource_id").alias("instance_id"),
            "recorded_at",
            F.lit("AWS_CONFIG").alias("flag"),
            as_json(tags).alias("tags"),
            launch_instant(launched).alias("launched"),
            digest_of(F.col("configuration")).alias("digest"),
            field(doc, "$.networkInterfaces", NETWORK_INTERFACES).alias("interfaces"),
        )
    )
    return (
        explode_parsed(snapshots, F.col("interfaces"), "interface")
        .withColumn("ip_address", F.col("interface.privateIpAddress"))
        .drop("interfaces", "interface")
    )


def _items(events: DataFrame) -> DataFrame:
    """One row per instance of each event, the instance as a document `item`."""
    parsed = events.withColumn(
        "items", field(document(F.col("response_elements")), "$.instancesSet.items", "array<variant>")
    )
    return explode_parsed(parsed, F.col("items"), "item").drop("items")


def _launches(cloudtrail: DataFrame) -> DataFrame:
    return _items(cloudtrail.where(F.col("event_name") == "RunInstances"))


def _launch_sightings(cloudtrail: DataFrame) -> DataFrame:
    """One row per instance of each launch event."""
    item = F.col("item")
    return _launches(cloudtrail).select(
        F.col("recipient_account_id").alias("account_id"),
        field(item, "$.instanceId").alias("instance_id"),
        "recorded_at",
        F.lit("CLOUDTRAIL").alias("flag"),
        as_json(tags_to_map(field(item, "$.tagSet.items", TAG_LIST), "key", "value")).alias("tags"),
        launch_instant(field(item, "$.launchTime")).alias("launched"),
        digest_of(as_json(item)).alias("digest"),
        field(item, "$.privateIpAddress").alias("ip_address"),
    )


def _sightings(config: DataFrame, cloudtrail: DataFrame) -> DataFrame:
    seen = _config_sightings(config).unionByName(_launch_sightings(cloudtrail))
    return seen.where(F.col("account_id").isNotNull() & F.col("instance_id").isNotNull()).withColumns(
        {name: F.col("recorded_at") for name in ("at", "first", "last")}
    )


def _latest() -> list[Column]:
    """First and last sighting, and the values at the last: of several then, the greatest of each."""
    values = [F.max(F.struct("last", c))[c].alias(c) for c in ("flag", "digest", "tags", "launched")]
    return [F.min("first").alias("first"), F.max("last").alias("last"), *values]


def _details(config: DataFrame, cloudtrail: DataFrame) -> DataFrame:
    recorded = _snapshots(config).select(F.col("recorded_at").alias("at"), F.col("configuration").alias("payload"))
    launched = _launches(cloudtrail).select(F.col("recorded_at").alias("at"), as_json(F.col("item")).alias("payload"))
    return recorded.unionByName(launched).where("payload is not null")


def _stops(cloudtrail: DataFrame) -> DataFrame:
    stops = cloudtrail.where(F.col("event_name").isin("StopInstances", "TerminateInstances"))
    return _items(stops).select(
        "recipient_account_id",
        field(F.col("item"), "$.instanceId").alias("end_instance"),
        F.col("recorded_at").alias("at"),
        F.col("event_time").alias("ended_at"),
    )


_BOTH = ("aws_config", "cloudtrail")
SIGHTINGS = Part("aws_instance_sightings", _BOTH, _sightings, ("account_id", "instance_id", "ip_address"), _latest)
ENDS = Part(
    "aws_instance_ends",
    ("cloudtrail",),
    _stops,
    ("recipient_account_id", "end_instance"),
    lambda: [F.max("ended_at").alias("ended_at")],
    time="event_time",
    latest="ended_at",
)
DETAILS = payload_part("aws_instance_details", _BOTH, _details)


def _instances(sightings: DataFrame, ends: DataFrame, details: DataFrame) -> DataFrame:
    # Serves the window below and the grouping after it.
    per_ip = sightings.repartition("instance_id")
    of_instance = Window.partitionBy("account_id", "instance_id")
    launch_time = F.when(F.col("first_seen") < F.col("launched"), F.col("first_seen")).otherwise(
        F.col("launched")
    )
    current = (
        per_ip.withColumn("last_seen", F.max("last").over(of_instance))
        .withColumn("first_seen", F.min("first").over(of_instance))
        .where(F.col("last") == F.col("last_seen"))
        .withColumn("launch_time", launch_time)
        .groupBy("instance_id", "ip_address")
        .agg(
            F.max("account_id").alias("account_id"),
            F.max("last").alias("recorded_at"),
            *[F.max(c).alias(c) for c in ("flag", "digest", "tags", "launch_time")],
        )
    )
    followed = next_start(
        current, "ip_address", "launch_time", ["instance_id"], "launch_time", "next_launch"
    )
    after = day_index(F.col("recorded_at")) <= day_index(F.col("ended_at"))
    ended = followed.join(ends, (F.col("instance_id") == F.col("end_instance")) & after, "left")
    return with_payload(ended, details, "details").select(
        "account_id",
        "details",
        "instance_id",
        "ip_address",
        "recorded_at",
        "flag",
        F.from_json("tags", TAG_MAP).alias("tags"),
        F.col("recorded_at").alias("latest_available_data"),
        "launch_time",
        F.col("launch_time").alias("window_start"),
        F.coalesce("ended_at", "next_launch").alias("window_end"),
    )


INSTANCES = EntityView(_instances, (SIGHTINGS, ENDS, DETAILS))


def aws_instances(
    config: DataFrame,
    cloudtrail: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta = "30 days",
) -> DataFrame:
    """EC2 instances seen in configuration snapshots and launch events: one row per (instance, IP).

    Of each account's instance only the sightings at its very latest recording count.
    A single aggregate per (account, instance, IP) keeps the latest values, the maximum of each on a tie, and for `details` the one
    with the greatest digest; the few IPs of an instance are then compared with each
    other. Details are fetched by digest at the end. `window_start` equals `launch_time`.
    """
    both = (config, cloudtrail)
    return _instances(
        SIGHTINGS.recent(both, now, lookback), ENDS.recent([cloudtrail], now, lookback), DETAILS.recent(both, now, lookback)
    )


def _requested_interfaces(cloudtrail: DataFrame) -> DataFrame:
    """Successful interface creations, with a guess at what the interface is for."""
    response = F.col("response")
    events = (
        cloudtrail.where(
            (F.col("event_name") == "CreateNetworkInterface") & F.col("error_code").isNull()
        )
        .withColumn("response", document(F.col("response_elements")))
        .withColumn("request_description", field(document(F.col("request_parameters")), "$.description"))
    )
    kind = None
    for column, test, value, name in INTERFACE_TYPE_RULES:
        c = F.col(column)
        hit = {"is": c == value, "starts": c.startswith(value), "ends": c.endswith(value)}[test]
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    instance = field(response, "$.instanceId")
    kind = kind.when(instance.isNull(), "ec2-instance").otherwise("unknown")
    return events.withColumn("object_type", kind).select(
        F.col("recorded_at").alias("at"),
        F.col("event_time").alias("seen_at"),
        F.col("recipient_account_id").alias("account_id"),
        field(response, "$.networkInterface.networkInterfaceId").alias("eni_id"),
        F.coalesce(
            field(response, "$.networkInterface.privateIpAddress"),
            field(response, "$.privateIpAddress"),
        ).alias("private_ip"),
        "object_type",
        F.when(F.col("object_type") == "network_load_balancer", F.col("request_description"))
        .otherwise("unknown")
        .alias("object_name"),
        instance.alias("eni_instance_id"),
        F.lit("network_interface_cloudtrail").alias("source"),
        F.lit(False).alias("recorded"),
    )


def _launched_interfaces(cloudtrail: DataFrame) -> DataFrame:
    """Interfaces of launched instances."""
    nics = field(F.col("item"), "$.networkInterfaceSet.items", NETWORK_INTERFACES)
    return explode_parsed(_launches(cloudtrail), nics, "nic").select(
        F.col("recorded_at").alias("at"),
        F.col("event_time").alias("seen_at"),
        F.col("recipient_account_id").alias("account_id"),
        F.col("nic.networkInterfaceId").alias("eni_id"),
        F.col("nic.privateIpAddress").alias("private_ip"),
        F.lit("ec2-instance").alias("object_type"),
        F.lit("ec2-instance").alias("object_name"),
        field(F.col("item"), "$.instanceId").alias("eni_instance_id"),
        F.lit("run_instance_cloudtrail").alias("source"),
        F.lit(False).alias("recorded"),
    )


def _recorded_interfaces(config: DataFrame) -> DataFrame:
    """Interfaces of configuration snapshots. Without a name of its own, one is named after the instance that lists it, if any."""
    plain = F.col("interface_type") == "interface"
    on_ec2 = (
        plain
        & field(document(F.col("attachment")), "$.PublicDnsName").startswith("ec2-")
        & F.col("groups").isNotNull()
    )
    addresses, about = F.col("private_ip_addresses"), F.col("description")
    object_type = (
        F.when(plain & F.col("attachment").isNull() & F.col("groups").contains("eks"), "kubernetes")
        .when(about.startswith("ELB "), "network_load_balancer")
        .when(on_ec2, "ec2")
        .when(addresses.contains("ec2.internal"), "ec2-instance")
        .when(addresses.contains("compute.internal"), "ec2-instance")
        .when(plain & about.startswith("AWS Lambda VPC ENI"), "lambda")
        .otherwise(F.col("interface_type"))
    )
    return config.where(F.col("resource_type") == "AWS::EC2::NetworkInterface").select(
        F.col("recorded_at").alias("at"),
        F.col("recorded_at").alias("seen_at"),
        "account_id",
        F.col("network_interface_id").alias("eni_id"),
        F.col("private_ip_address").alias("private_ip"),
        object_type.alias("object_type"),
        F.when(about != "", about).when(on_ec2, "ec2-instance").alias("object_name"),
        F.lit(None).cast("string").alias("eni_instance_id"),
        F.lit("config").alias("source"),
        F.lit(True).alias("recorded"),
    )


def _interface_sightings(config: DataFrame, cloudtrail: DataFrame) -> DataFrame:
    seen = (
        _recorded_interfaces(config)
        .unionByName(_requested_interfaces(cloudtrail))
        .unionByName(_launched_interfaces(cloudtrail))
    )
    times = {name: F.col("seen_at") for name in ("window_start", "last_recorded")}
    return seen.withColumns({**times, "unnamed": F.col("recorded") & F.col("object_name").isNull()})


def _extremes() -> list[Column]:
    least = [F.min(c).alias(c) for c in ("window_start", "private_ip", "object_type")]
    greatest = ("last_recorded", "object_name", "eni_instance_id", "source", "recorded", "unnamed")
    return [*least, *[F.max(c).alias(c) for c in greatest]]


def _listing_instances(instances: DataFrame) -> DataFrame:
    """Interfaces that instances list, each with the greatest instance: no other can reach the result."""
    details = F.col("doc")
    listed = F.coalesce(
        F.transform(
            field(details, "$.NetworkInterfaces", "array<struct<NetworkInterfaceId: string>>"),
            lambda nic: nic["NetworkInterfaceId"],
        ),
        F.transform(
            field(details, "$.networkInterfaces", NETWORK_INTERFACES),
            lambda nic: nic["networkInterfaceId"],
        ),
    )
    described = instances.select("instance_id", document(F.col("details")).alias("doc"))
    return (
        explode_parsed(described, listed, "listed_eni")
        .groupBy("listed_eni")
        .agg(F.max("instance_id").alias("listed_instance"))
    )


def _enis(sightings: DataFrame, instances: DataFrame) -> DataFrame:
    owned = F.col("listed_instance")
    by_owner = F.when(owned.isNotNull(), "ec2-instance").otherwise("unknown")
    grouped = sightings.join(_listing_instances(instances), F.col("eni_id") == F.col("listed_eni"), "left").select(
        "eni_id",
        "account_id",
        "window_start",
        "last_recorded",
        "private_ip",
        "object_type",
        F.greatest("object_name", F.when(F.col("unnamed"), by_owner)).alias("object_name"),
        F.greatest("eni_instance_id", F.when(F.col("recorded"), F.coalesce(owned, F.lit("config")))).alias("eni_instance_id"),
        "source",
    )
    return next_start(
        grouped, "private_ip", "window_start", ["eni_id", "account_id"], "window_start", "window_end"
    )


INTERFACES = Part(
    "aws_interface_sightings", _BOTH, _interface_sightings, ("eni_id", "account_id"), _extremes, lookback=None
)
ENIS = EntityView(_enis, (INTERFACES,), ("aws_instances",))


def aws_enis(
    config: DataFrame,
    cloudtrail: DataFrame,
    instances: DataFrame,
    now: datetime | Column | None = None,
    lookback: str | timedelta | None = None,
) -> DataFrame:
    """Network interfaces: one row per (interface, account) with its lifetime.

    `instances` is the output of `aws_instances`. The lifetime ends when the next interface takes
    over the address. Duplicates need no removal, as only minima and maxima follow, and these are taken before
    the instances are joined. Without a `lookback` all history counts.
    """
    return _enis(INTERFACES.recent((config, cloudtrail), now, lookback), instances)
