"""Every operator over whole derived tables. Results are scalars: times in epoch seconds, tags as text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark import operators as op
from flowspark.functions import as_json, canonical_json, tag, tags_to_map
from flowspark.operators.beaconing import joined_stretches
from flowspark.plans import EntityDays, FlowViews, RollingBaseline
from flowspark.sources import admit, cut_lineage, materialize, new_kept_path, read_source, remove_at_exit
from workload import inputs as i

Query = Callable[[SparkSession, str], DataFrame]
NOW = i.NOW_TIME


def _epoch(*names: str) -> list[Column]:
    return [F.unix_seconds(n).alias(n) for n in names]


def _role(column: str, name: str) -> Column:
    return tag(F.col(column)).alias(name)


def _rounded(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


# ---- AWS ----


def _digest(payload: str) -> Column:
    return F.sha2(payload, 256).alias(f"{payload}_sha256")


def _instances(spark: SparkSession, sf: str) -> DataFrame:
    return op.aws_instances(i.aws_config(spark, sf), i.cloudtrail(spark, sf), now=NOW)


def _instance_columns() -> list:
    return [
        "instance_id",
        "account_id",
        "ip_address",
        "flag",
        as_json(F.col("tags")).alias("tags"),
        _digest("details"),
        *_epoch("recorded_at", "latest_available_data", "launch_time", "window_start", "window_end"),
    ]


def aws_instances(spark: SparkSession, sf: str) -> DataFrame:
    return _instances(spark, sf).select(*_instance_columns())


def _days(spark: SparkSession, sf: str, *names: str) -> EntityDays:
    """All days of the sources merged, and the last two of them once more, as when records come late."""
    path = new_kept_path(spark)
    days = EntityDays(spark, path, {name: getattr(i, name)(spark, sf) for name in names})
    days.merge()
    remove_at_exit(spark, path)
    days.merge(date(2024, 1, 29), date(2024, 1, 30))
    return days


def aws_instances_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return _days(spark, sf, "aws_config", "cloudtrail").view("aws_instances", NOW).select(*_instance_columns())


def aws_enis(spark: SparkSession, sf: str, instances: DataFrame | None = None) -> DataFrame:
    instances = instances or i.aws_instances(spark, sf)
    out = op.aws_enis(i.aws_config(spark, sf), i.cloudtrail(spark, sf), instances)
    return out.select(
        "eni_id",
        "account_id",
        "private_ip",
        "object_type",
        "object_name",
        "eni_instance_id",
        "source",
        *_epoch("window_start", "last_recorded", "window_end"),
    )


_AWS_FLOW = [
    "accountid",
    "instanceid",
    "interfaceid",
    "srcaddr",
    "srcport",
    "dstaddr",
    "dstport",
    "protocol",
    "packets",
    "bytes",
    "tcpflags",
    "action",
]


def _aws_flows(spark: SparkSession, sf: str) -> DataFrame:
    return op.aws_flow_logs(i.aws_flow_logs_raw(spark, sf))


def _aws_ec2(spark: SparkSession, sf: str, flows: DataFrame | None = None, **options) -> DataFrame:
    instances = i.aws_instances(spark, sf)
    return op.aws_flow_logs_join_ec2(flows or _aws_flows(spark, sf), instances, **options)


def aws_flow_logs(spark: SparkSession, sf: str) -> DataFrame:
    return _aws_flows(spark, sf).select(*_AWS_FLOW, *_epoch("recorded_at", "starttime", "endtime"))


def _ec2_columns() -> list:
    return [
        *_AWS_FLOW,
        *_epoch("starttime"),
        "src_instance_id",
        "src_account_id",
        _role("src_tags", "src_role"),
        "dst_instance_id",
        "dst_account_id",
        _role("dst_tags", "dst_role"),
        "owner_is_src",
    ]


def aws_flow_logs_join_ec2(spark: SparkSession, sf: str) -> DataFrame:
    return _aws_ec2(spark, sf).select(*_ec2_columns())


def aws_flow_logs_join_ec2_closed(spark: SparkSession, sf: str) -> DataFrame:
    return _aws_ec2(spark, sf, open_end=False).select(*_ec2_columns())


def aws_flow_logs_join_enis(spark: SparkSession, sf: str) -> DataFrame:
    flows, enis = _aws_flows(spark, sf), i.aws_enis(spark, sf)
    return op.aws_flow_logs_join_enis(flows, enis).select(
        *_AWS_FLOW,
        *_epoch("starttime"),
        "eni_id",
        "eni_private_ip",
        "eni_account_id",
        "peer_eni_id",
        "peer_eni_private_ip",
        "peer_eni_account_id",
    )


_GAP_STATS = [
    "avg_prev_time_diff",
    "stddev_prev_time_diff",
    "variance_prev_time_diff",
    "avg_connection_duration",
    "stddev_connection_duration",
]
# Thresholds that let every group with a gap variance through.
_OPEN = {"min_count": 0, "max_variance": 1e12, "min_gap": -1}


def aws_beaconing(spark: SparkSession, sf: str, **options) -> DataFrame:
    out = op.aws_beaconing(i.aws_beacon_flows(spark, sf), now=NOW, **options)
    return out.select("beacon_count", *_rounded(*_GAP_STATS), "instanceid", "srcaddr", "dstaddr")


def aws_beaconing_all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return aws_beaconing(spark, sf, **_OPEN)


def _hours_since(hours: int) -> int:
    return int((NOW - timedelta(hours=hours)).timestamp()) // 3600


def aws_beaconing_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """All flows in kept hours, the last four of them joined."""
    hours = cut_lineage(op.aws_beacon_hours(i.aws_beacon_flows(spark, sf)))
    out = op.aws_beaconing_of(hours.where(F.col("stretch") >= _hours_since(4)), **_OPEN)
    return out.select("beacon_count", *_rounded(*_GAP_STATS), "instanceid", "srcaddr", "dstaddr")


def _chained(spark: SparkSession, sf: str) -> FlowViews:
    """The views above the machines that the entity operator derives from configuration and audit logs."""
    names = ("aws_flow_logs_raw", "aws_config", "cloudtrail", "iocs")
    return FlowViews({name: getattr(i, name)(spark, sf) for name in names}, now=NOW)


def aws_enis_chained(spark: SparkSession, sf: str) -> DataFrame:
    return aws_enis(spark, sf, cut_lineage(_instances(spark, sf)))


def aws_flow_logs_join_ec2_chained(spark: SparkSession, sf: str) -> DataFrame:
    return _chained(spark, sf)["aws_flow_logs_join_ec2"].select(*_ec2_columns())


def aws_ioc_connections_chained(spark: SparkSession, sf: str) -> DataFrame:
    return _chained(spark, sf)["aws_ioc_connections"].select(*_ec2_columns(), "ioc_value")


def aws_unusual_role_ports_chained(spark: SparkSession, sf: str) -> DataFrame:
    return _chained(spark, sf)["aws_unusual_role_ports"].select(*_ec2_columns())


def aws_ioc_connections(spark: SparkSession, sf: str) -> DataFrame:
    iocs = i.iocs(spark, sf)
    listed = op.aws_listed_flows(_aws_flows(spark, sf), iocs)
    return op.aws_ioc_connections(_aws_ec2(spark, sf, listed), iocs).select(*_ec2_columns(), "ioc_value")


_RST = ["avg_rst_by_role", "stddev_rst_by_role"]


def aws_rst_baseline(spark: SparkSession, sf: str) -> DataFrame:
    out = op.aws_rst_baseline(_aws_flows(spark, sf), i.aws_instances(spark, sf), now=NOW)
    return out.select(*_rounded(*_RST), "instance_role")


def _rolled(spark: SparkSession, flows: DataFrame, keys: list[str], counts, **options) -> DataFrame:
    """Moments of the baseline that was started an hour ago and moved on by one."""
    path = new_kept_path(spark)
    baseline = RollingBaseline(spark, path, keys, counts, **options)
    baseline.start(flows, NOW - timedelta(hours=1))
    remove_at_exit(spark, path)
    baseline.advance(flows, NOW)
    return baseline.moments(NOW)


def aws_rst_baseline_rolling(spark: SparkSession, sf: str) -> DataFrame:
    instances = i.aws_instances(spark, sf)
    counts = lambda flows: op.aws_hourly_resets(flows, instances)
    moments = _rolled(spark, _aws_flows(spark, sf), ["instance_role"], counts)
    return op.aws_rst_baseline_of_moments(moments, instances, now=NOW).select(*_rounded(*_RST), "instance_role")


def aws_port_scanning(spark: SparkSession, sf: str) -> DataFrame:
    instances = i.aws_instances(spark, sf)
    counts = cut_lineage(op.aws_reset_counts(_aws_flows(spark, sf), now=NOW))
    out = op.aws_port_scanning_of(counts, instances, op.aws_rst_baseline_of(counts, instances, now=NOW))
    return out.select("rst_last_hour", "instanceid", "instance_role", *_rounded(*_RST))


def aws_unusual_role_ports(spark: SparkSession, sf: str) -> DataFrame:
    return op.aws_unusual_role_ports(_aws_ec2(spark, sf)).select(*_ec2_columns())


# ---- Azure ----


def _nics(spark: SparkSession, sf: str, **options) -> DataFrame:
    logs, inventory = i.azure_logs(spark, sf), i.azure_collect_network_interfaces(spark, sf)
    return op.azure_nics(logs, inventory, now=NOW, **options)


def _nic_columns() -> list:
    return [
        "tenant_id",
        "subscription_id",
        "nic_id",
        "nic_name",
        "nic_location",
        _digest("nic_properties"),
        "ip_configuration",
        as_json(F.col("nic_tags")).alias("nic_tags"),
        "source",
        "private_ip",
        *_epoch("earliest", "window_start", "window_end"),
    ]


def azure_nics(spark: SparkSession, sf: str, **options) -> DataFrame:
    return _nics(spark, sf, **options).select(*_nic_columns())


def azure_nics_by_day(spark: SparkSession, sf: str) -> DataFrame:
    days = _days(spark, sf, "azure_logs", "azure_collect_network_interfaces")
    return days.view("azure_nics", NOW).select(*_nic_columns())


def azure_nics_all_ips(spark: SparkSession, sf: str) -> DataFrame:
    return azure_nics(spark, sf, keep_all_ips=True)


def _vms(spark: SparkSession, sf: str) -> DataFrame:
    logs, inventory = i.azure_logs(spark, sf), i.azure_collect_virtual_machines(spark, sf)
    return op.azure_vms(logs, inventory, now=NOW)


def azure_vms(spark: SparkSession, sf: str) -> DataFrame:
    return _vms(spark, sf).select(
        *_epoch("window_start", "window_end"),
        "tenant_id",
        "subscription_id",
        "vm_id",
        "vm_name",
        _digest("properties"),
        "location",
        as_json(F.col("tags")).alias("tags"),
    )


def azure_vms_nics(spark: SparkSession, sf: str) -> DataFrame:
    return op.azure_vms_nics(_vms(spark, sf), _nics(spark, sf)).select(
        "vm_id",
        "vm_name",
        "vm_nic_id",
        as_json(F.col("vm_tags")).alias("vm_tags"),
        "private_ip",
        *_epoch("vm_window_start", "vm_window_end", "window_start", "window_end"),
    )


def _azure_flows(spark: SparkSession, sf: str) -> DataFrame:
    return op.azure_flow_logs(i.azure_flow_logs_raw(spark, sf))


_AZURE_FLOW = [
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


def azure_flow_logs(spark: SparkSession, sf: str) -> DataFrame:
    return _azure_flows(spark, sf).select(
        *_epoch("recorded_at", "time_stamp", "event_time"),
        "category",
        "operation_name",
        "system_id",
        "flow_mac",
        *_AZURE_FLOW,
    )


def _azure_enriched(
    spark: SparkSession, sf: str, vms: DataFrame | None = None, flows: DataFrame | None = None
) -> DataFrame:
    """Enriched flows. The entities are kept, because the join reads them more than once."""
    if vms is None:
        vms = _vms(spark, sf)
    vms_nics = cut_lineage(op.azure_vms_nics(vms, _nics(spark, sf)))
    lifetimes = cut_lineage(op.azure_lifetimes(vms_nics))
    return op.azure_flow_logs_join_lifetimes(flows or _azure_flows(spark, sf), lifetimes)


def _azure_enriched_columns() -> list:
    return [
        *_epoch("flow_recorded_at", "event_time"),
        *_AZURE_FLOW,
        "src_nic_id",
        "src_ip_addr",
        "src_vm_id",
        as_json(F.col("src_vm_tags")).alias("src_vm_tags"),
        "dst_nic_id",
        "dst_ip_addr",
        "dst_vm_id",
        as_json(F.col("dst_vm_tags")).alias("dst_vm_tags"),
    ]


def azure_flow_logs_join_vm_nics(spark: SparkSession, sf: str) -> DataFrame:
    return _azure_enriched(spark, sf).select(*_azure_enriched_columns())


def azure_ioc_connections(spark: SparkSession, sf: str) -> DataFrame:
    iocs = i.iocs(spark, sf)
    listed = op.azure_listed_flows(_azure_flows(spark, sf), iocs)
    out = op.azure_ioc_connections(_azure_enriched(spark, sf, flows=listed), iocs)
    return out.select(*_azure_enriched_columns(), "ioc_value")


def _azure_denied(spark: SparkSession, sf: str) -> DataFrame:
    """Denied flows. Records that hold none are told by their text, and not parsed."""
    return op.azure_denied_flows(op.azure_flow_logs(op.azure_denied_records(i.azure_flow_logs_raw(spark, sf))))


def azure_denied_baseline(spark: SparkSession, sf: str) -> DataFrame:
    vms = cut_lineage(_vms(spark, sf))
    denied = _azure_denied(spark, sf)
    out = op.azure_denied_baseline(_azure_enriched(spark, sf, vms, denied), vms, now=NOW)
    return out.select(*_rounded("avg_denied_count", "stddev_denied_count"), "src_role")


def azure_denied_baseline_rolling(spark: SparkSession, sf: str) -> DataFrame:
    vms = cut_lineage(_vms(spark, sf))
    denied = _azure_denied(spark, sf)
    enriched = _azure_enriched(spark, sf, vms, denied)
    flows = cut_lineage(enriched.select("flow_recorded_at", "traffic_decision", "src_vm_tags"))
    options = {"time": "flow_recorded_at", "by_hour_of_day": False}
    moments = _rolled(spark, flows, ["src_role"], op.azure_hourly_denied, **options)
    out = op.azure_denied_baseline_of_moments(moments, vms, now=NOW)
    return out.select(*_rounded("avg_denied_count", "stddev_denied_count"), "src_role")


def azure_port_scanning(spark: SparkSession, sf: str) -> DataFrame:
    vms = cut_lineage(_vms(spark, sf))
    denied = _azure_denied(spark, sf)
    counts = cut_lineage(op.azure_denied_counts(_azure_enriched(spark, sf, vms, denied), now=NOW))
    return op.azure_port_scanning_of(counts, op.azure_denied_baseline_of(counts, vms, now=NOW))


# ---- GCP ----


def _gcp_vms(spark: SparkSession, sf: str) -> DataFrame:
    return op.gcp_vms(i.gcp_audit_logs(spark, sf), i.gcp_cloud_assets(spark, sf), now=NOW)


def _gcp_vm_columns() -> list:
    return [
        "account",
        "vm_name",
        "project_name",
        "zone",
        "resource_name",
        as_json(F.col("tags")).alias("tags"),
        "nics",
        *_epoch("earliest", "last_seen", "term_time"),
    ]


def gcp_vms(spark: SparkSession, sf: str) -> DataFrame:
    return _gcp_vms(spark, sf).select(*_gcp_vm_columns())


def gcp_vms_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return _days(spark, sf, "gcp_audit_logs", "gcp_cloud_assets").view("gcp_vms", NOW).select(*_gcp_vm_columns())


def _gcp_flows(spark: SparkSession, sf: str) -> DataFrame:
    return op.gcp_flow_logs(i.gcp_audit_logs(spark, sf), now=NOW, lookback="25 hours")


def gcp_flow_logs(spark: SparkSession, sf: str) -> DataFrame:
    flows = op.gcp_flow_logs(i.gcp_audit_logs(spark, sf), now=NOW)
    return flows.withColumns(
        {c: F.unix_seconds(c) for c in ("recorded_at", "event_time", "start_time", "end_time")}
    ).drop("raw")


_GCP_FLOW = ["src_ip", "src_port", "dst_ip", "dst_port", "protocol", "bytes", "src_vm_name", "dst_vm_name"]


def _gcp_joined_columns() -> list:
    return [
        *_epoch("recorded_at", "start_time", "end_time"),
        *_GCP_FLOW,
        as_json(F.col("src_tags")).alias("src_tags"),
        "src_nics",
        as_json(F.col("dst_tags")).alias("dst_tags"),
        "dst_nics",
    ]


def _gcp_joined(
    spark: SparkSession, sf: str, vms: DataFrame | None = None, flows: DataFrame | None = None
) -> DataFrame:
    """Joined flows. The VMs are kept, because the join reads them more than once."""
    if vms is None:
        vms = cut_lineage(_gcp_vms(spark, sf))
    return op.gcp_flow_logs_join_vms(flows or _gcp_flows(spark, sf), vms)


def gcp_flow_logs_join_vms(spark: SparkSession, sf: str) -> DataFrame:
    return _gcp_joined(spark, sf).select(*_gcp_joined_columns())


def gcp_beaconing(spark: SparkSession, sf: str, **options) -> DataFrame:
    out = op.gcp_beaconing(i.gcp_beacon_flows(spark, sf), now=NOW, **options)
    return out.select("beacon_count", *_rounded(*_GAP_STATS), "src_vm_name", "src_ip", "dst_ip")


def gcp_beaconing_all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return gcp_beaconing(spark, sf, **_OPEN)


def gcp_beaconing_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """All flows in kept quarters of an hour, joined to hours, the last four of them joined."""
    outbound = {"host": "src_vm_name", "src": "src_ip", "dst": "dst_ip"}
    quarters = cut_lineage(op.gcp_beacon_hours(i.gcp_beacon_flows(spark, sf), minutes=15))
    hours = joined_stretches(quarters, **outbound, ratio=4)
    out = op.gcp_beaconing_of(hours.where(F.col("stretch") >= _hours_since(4)), **_OPEN)
    return out.select("beacon_count", *_rounded(*_GAP_STATS), "src_vm_name", "src_ip", "dst_ip")


def gcp_ioc_connections(spark: SparkSession, sf: str) -> DataFrame:
    iocs = i.iocs(spark, sf)
    listed = op.gcp_listed_flows(_gcp_flows(spark, sf), iocs)
    out = op.gcp_ioc_connections(_gcp_joined(spark, sf, flows=listed), iocs)
    return out.select(*_gcp_joined_columns(), "ioc_value")


_MISS = ["avg_miss_count", "stddev_miss_count"]


def gcp_connect_baseline(spark: SparkSession, sf: str) -> DataFrame:
    vms = cut_lineage(_gcp_vms(spark, sf))
    out = op.gcp_connect_baseline(_gcp_joined(spark, sf, vms), vms, now=NOW)
    return out.select(*_rounded(*_MISS), "src_role", "dst_role")


def gcp_connect_baseline_rolling(spark: SparkSession, sf: str) -> DataFrame:
    vms = cut_lineage(_gcp_vms(spark, sf))
    columns = ["recorded_at", "start_time", "end_time", "bytes", "src_tags", "dst_tags"]
    flows = op.gcp_flow_logs(i.gcp_audit_logs(spark, sf), now=NOW, lookback="26 hours")
    flows = cut_lineage(_gcp_joined(spark, sf, vms, op.gcp_missed_flows(flows)).select(*columns))
    moments = _rolled(spark, flows, ["src_role", "dst_role"], op.gcp_hourly_misses)
    out = op.gcp_connect_baseline_of_moments(moments, vms, now=NOW)
    return out.select(*_rounded(*_MISS), "src_role", "dst_role")


def gcp_port_scanning(spark: SparkSession, sf: str, k: float = 1) -> DataFrame:
    vms = cut_lineage(_gcp_vms(spark, sf))
    counts = cut_lineage(op.gcp_miss_counts(_gcp_joined(spark, sf, vms), now=NOW))
    out = op.gcp_port_scanning_of(counts, op.gcp_connect_baseline_of(counts, vms, now=NOW), k=k)
    return out.select("miss_count", "src_vm_name", "dst_role", "src_role", *_rounded(*_MISS))


# ---- all ----


def universal_flow_log(spark: SparkSession, sf: str) -> DataFrame:
    out = op.universal_flow_log(_aws_flows(spark, sf), _gcp_flows(spark, sf), _azure_flows(spark, sf))
    return out.withColumns({c: F.unix_seconds(c) for c in ("recorded_at", "event_time")})


# Sources with JSON records, and the column of each that is cut off in records of some seconds.
_CUT = {
    "aws_config": "configuration",
    "cloudtrail": "response_elements",
    "azure_collect_network_interfaces": "properties",
    "azure_flow_logs_raw": "flow_raw",
    "gcp_cloud_assets": "raw",
}


def admitted_records(spark: SparkSession, sf: str) -> DataFrame:
    """Per source how many records came, were admitted, and are in the quarantine, when some were cut off.

    One source comes as JSON lines, one from a table that was written by day.
    """
    found = None
    for name, column in _CUT.items():
        rows = getattr(i, name)(spark, sf)
        text = F.col(column)
        cut = F.unix_seconds("recorded_at") % 97 == 0
        broken = rows.withColumn(column, F.when(cut, F.substring(text, 1, 20)).otherwise(text))
        written, path = new_kept_path(spark), new_kept_path(spark)
        if name == "cloudtrail":
            broken.write.json(written, compression="gzip")
            remove_at_exit(spark, written)
            broken = read_source(spark, name, written, "json", keep_corrupt=True)
        elif name == "aws_config":
            materialize(broken, path=written, date_column="recorded_at")
            remove_at_exit(spark, written)
            broken = read_source(spark, name, written)
        good, bad = admit(broken, name, path)
        remove_at_exit(spark, path)
        counts = good.select(F.lit(1).alias("a"), F.lit(0).alias("q")).unionByName(bad.select(F.lit(0).alias("a"), F.lit(1).alias("q")))
        counts = counts.agg(F.count("*").alias("records"), F.sum("a").alias("admitted"), F.sum("q").alias("quarantined"))
        counts = counts.withColumn("source", F.lit(name))
        found = counts if found is None else found.unionByName(counts)
    return found


def tags_to_map_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = i.flat(spark, sf, "select * from tag_list").selectExpr(
        "n",
        """array(map('name', 'k1', 'content', v1), map('name', second_key, 'content', v2),
                 map('name', 'k3')) as tags""",
    )
    return rows.select("n", as_json(tags_to_map(F.col("tags"), "name", "content")).alias("tags"))


def canonical_json_query(spark: SparkSession, sf: str) -> DataFrame:
    """Payload text of the events table, as payloads are compared."""
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", canonical_json(F.col("props")).alias("props")
    )


QUERIES: dict[str, Query] = {
    "aws_instances": aws_instances,
    "aws_instances_by_day": aws_instances_by_day,
    "aws_enis": aws_enis,
    "aws_enis_chained": aws_enis_chained,
    "aws_flow_logs": aws_flow_logs,
    "aws_flow_logs_join_ec2": aws_flow_logs_join_ec2,
    "aws_flow_logs_join_ec2_closed": aws_flow_logs_join_ec2_closed,
    "aws_flow_logs_join_enis": aws_flow_logs_join_enis,
    "aws_beaconing": aws_beaconing,
    "aws_beaconing_all_pairs": aws_beaconing_all_pairs,
    "aws_beaconing_by_hour": aws_beaconing_by_hour,
    "aws_flow_logs_join_ec2_chained": aws_flow_logs_join_ec2_chained,
    "aws_ioc_connections": aws_ioc_connections,
    "aws_ioc_connections_chained": aws_ioc_connections_chained,
    "aws_rst_baseline": aws_rst_baseline,
    "aws_rst_baseline_rolling": aws_rst_baseline_rolling,
    "aws_port_scanning": aws_port_scanning,
    "aws_unusual_role_ports": aws_unusual_role_ports,
    "aws_unusual_role_ports_chained": aws_unusual_role_ports_chained,
    "azure_nics": azure_nics,
    "azure_nics_by_day": azure_nics_by_day,
    "azure_nics_all_ips": azure_nics_all_ips,
    "azure_vms": azure_vms,
    "azure_vms_nics": azure_vms_nics,
    "azure_flow_logs": azure_flow_logs,
    "azure_flow_logs_join_vm_nics": azure_flow_logs_join_vm_nics,
    "azure_ioc_connections": azure_ioc_connections,
    "azure_denied_baseline": azure_denied_baseline,
    "azure_denied_baseline_rolling": azure_denied_baseline_rolling,
    "azure_port_scanning": azure_port_scanning,
    "gcp_vms": gcp_vms,
    "gcp_vms_by_day": gcp_vms_by_day,
    "gcp_flow_logs": gcp_flow_logs,
    "gcp_flow_logs_join_vms": gcp_flow_logs_join_vms,
    "gcp_beaconing": gcp_beaconing,
    "gcp_beaconing_all_pairs": gcp_beaconing_all_pairs,
    "gcp_beaconing_by_hour": gcp_beaconing_by_hour,
    "gcp_ioc_connections": gcp_ioc_connections,
    "gcp_connect_baseline": gcp_connect_baseline,
    "gcp_connect_baseline_rolling": gcp_connect_baseline_rolling,
    "gcp_port_scanning": gcp_port_scanning,
    "universal_flow_log": universal_flow_log,
    "admitted_records": admitted_records,
    "tags_to_map": tags_to_map_query,
    "canonical_json": canonical_json_query,
}
