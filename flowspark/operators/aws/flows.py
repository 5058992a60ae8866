"""VPC flow logs and their joins to instances and interfaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import partition_day
from flowspark.operators.joins import BROADCAST_LIMIT_BYTES, id_join, lifetime_join, networks_of, size_by, with_held

FLOW_COLUMNS = [field.split()[0] for field in schemas.AWS_FLOW_LOGS.split(",")]
_SPREAD_BY = ["srcaddr", "dstaddr", "srcport", "dstport", "starttime"]


def aws_flow_logs(raw: DataFrame) -> DataFrame:
    """The flow log columns, without whatever else the ingest added."""
    return raw.select(*FLOW_COLUMNS, *partition_day(raw))


def _peer_ip(owner_ip: Column) -> Column:
    """The end of the flow that is not the owner's; null when the owner's address is on neither."""
    src, dst = F.col("srcaddr"), F.col("dstaddr")
    return F.when(src == owner_ip, dst).when(dst == owner_ip, src)


def aws_flow_logs_join_ec2(
    flows: DataFrame,
    instances: DataFrame,
    open_end: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Flows with the instance that owns the interface (`src_*`) and the peer instance (`dst_*`).

    The owner is found by instance id, the peer by the other address and the time. So `src_*` is the
    owner whatever the direction of the flow; `owner_is_src` tells it. An instance with
    several addresses gives several rows. `instances` is measured, and broadcast up to
    `broadcast_limit` bytes; see `lifetime_join` for what happens beyond it.
    """
    entity = ["instance_id", "account_id", "tags", "details"]
    size = size_by(instances.select(*entity, "ip_address"), "ip_address")
    owners = instances.select(
        *[F.col(c).alias(f"src_{c}") for c in entity], F.col("ip_address").alias("_owner_ip")
    )
    peers = instances.select(
        *[F.col(c).alias(f"dst_{c}") for c in entity],
        F.col("ip_address").alias("_peer_address"),
        F.col("window_start").alias("_peer_start"),
        F.col("window_end").alias("_peer_end"),
    )
    small = size.total <= broadcast_limit

    def owned(some: DataFrame) -> DataFrame:
        return (
            id_join(some, owners, "instanceid", "src_instance_id", _SPREAD_BY, small)
            .withColumn("owner_is_src", F.col("srcaddr") == F.col("_owner_ip"))
            .withColumn("_peer_ip", _peer_ip(F.col("_owner_ip")))
        )

    def met(some: DataFrame) -> DataFrame:
        return lifetime_join(
            owned(some),
            peers,
            left_ip="_peer_ip",
            left_time="starttime",
            right_ip="_peer_address",
            right_start="_peer_start",
            right_end="_peer_end",
            spread_by=_SPREAD_BY,
            condition=lambda peer: peer["dst_instance_id"] != F.col("instanceid"),
            open_end=open_end,
            size=size,
            broadcast_limit=broadcast_limit,
        )

    columns = [*flows.columns, *[f"src_{c}" for c in entity], *[f"dst_{c}" for c in entity], "owner_is_src"]
    networks = None if small else networks_of(instances, "ip_address")
    if networks is None:
        return met(flows).select(*columns)
    # Who has a peer has an owner at the other end: flows without instances' networks at both ends are not shuffled again.
    marked = with_held(with_held(flows, networks, "srcaddr", "_src_held"), networks, "dstaddr", "_dst_held")
    no_peer = [F.lit(None).cast(peers.schema[f"dst_{c}"].dataType).alias(f"dst_{c}") for c in entity]
    alone = owned(marked.where("not (_src_held and _dst_held)")).select("*", *no_peer)
    return met(marked.where("_src_held and _dst_held")).select(*columns).unionByName(alone.select(*columns))


def aws_flow_logs_join_enis(
    flows: DataFrame,
    enis: DataFrame,
    open_end: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Flows with the interface they were recorded at (`eni_*`) and the peer interface (`peer_*`)."""
    size = size_by(enis, "private_ip")
    owners = enis.select(*[F.col(c).alias(_prefixed("eni_", c)) for c in enis.columns])
    peers = enis.select(*[F.col(c).alias("peer_" + _prefixed("eni_", c)) for c in enis.columns])
    owned = id_join(flows, owners, "interfaceid", "eni_id", _SPREAD_BY, size.total <= broadcast_limit).withColumn(
        "_peer_ip", _peer_ip(F.col("eni_private_ip"))
    )
    return lifetime_join(
        owned,
        peers,
        left_ip="_peer_ip",
        left_time="starttime",
        right_ip="peer_eni_private_ip",
        right_start="peer_eni_window_start",
        right_end="peer_eni_window_end",
        spread_by=_SPREAD_BY,
        condition=lambda peer: peer["peer_eni_id"] != F.col("interfaceid"),
        open_end=open_end,
        size=size,
        broadcast_limit=broadcast_limit,
    ).drop("_peer_ip")


def _prefixed(prefix: str, name: str) -> str:
    return name if name.startswith(prefix) else prefix + name
