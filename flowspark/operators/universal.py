"""The few columns all three clouds share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# IP protocol numbers that are kept.
PROTOCOL_NAMES = {6: "TCP", 17: "UDP"}


def _named(df: DataFrame, event_time: str, src: str, src_port: str, dst: str, dst_port: str, protocol: Column) -> DataFrame:
    return df.select(
        "recorded_at",
        F.col(event_time).alias("event_time"),
        F.col(src).alias("src_addr"),
        F.col(src_port).alias("src_port"),
        F.col(dst).alias("dst_addr"),
        F.col(dst_port).alias("dst_port"),
        protocol.alias("protocol"),
    )


def universal_flow_log(aws: DataFrame, gcp: DataFrame, azure: DataFrame) -> DataFrame:
    """TCP and UDP flows of AWS and GCP and all flows of Azure, under common names."""
    number = F.col("protocol")
    name = F.when(number == 6, PROTOCOL_NAMES[6]).when(number == 17, PROTOCOL_NAMES[17])
    kept = number.isin(*PROTOCOL_NAMES)
    return (
        _named(aws.where(kept), "starttime", "srcaddr", "srcport", "dstaddr", "dstport", name)
        .unionByName(_named(gcp.where(kept), "start_time", "src_ip", "src_port", "dst_ip", "dst_port", name))
        .unionByName(_named(azure, "event_time", "src_addr", "src_port", "dst_addr", "dst_port", number))
    )
