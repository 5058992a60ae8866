"""Spark sources in the shape of the real ones, built from the flat rows.

Nested records are packed into JSON row by row, without a shuffle, by expressions that are compiled:
none has a lambda, and none stands in a projection with one.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import apart
from flowspark.sources import conform
from workload.flat import NOW, with_flat

NOW_TIME = datetime.fromtimestamp(NOW, tz=timezone.utc)
ROWS_A_TASK = 250_000
_OF_FLOWS = ("lineitem", "events")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Row groups may be few, so rows are dealt out unless the scan has a task per core, and, but for those that
    flows are made of, one per `ROWS_A_TASK`: records of these rows are sorted where they are made."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = spark.sparkContext.defaultParallelism
    if name not in _OF_FLOWS:
        tasks = max(tasks, -(-df.count() // ROWS_A_TASK))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def flat(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a query over flat entries and test tables."""
    sql = with_flat(text).replace("//", " div ")
    for name in TABLES:
        if re.search(rf"\bfrom {name}\b", sql):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def _times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.timestamp_seconds(c) for c in columns})


def _iso(epoch: str) -> str:
    return f"date_format(timestamp_seconds({epoch}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def aws_flow_logs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "select * from flow")
    return conform(_times(rows, "recorded_at", "starttime", "endtime"), schemas.AWS_FLOW_LOGS)


def aws_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the shape of the instance view; each lists its own interface."""
    rows = _times(
        flat(spark, sf_dir, "select * from machine"),
        "window_start",
        "window_end",
        "latest_available_data",
    )
    role = F.col("instance_role")
    return rows.select(
        "account_id",
        F.to_json(
            F.struct(F.array(F.struct(F.col("eni_id").alias("networkInterfaceId"))).alias("networkInterfaces"))
        ).alias("details"),
        "instance_id",
        "ip_address",
        F.when(role.isNull(), F.create_map()).otherwise(F.create_map(F.lit("instance_role"), role))
        .cast("map<string,string>")
        .alias("tags"),
        "latest_available_data",
        "window_start",
        "window_end",
    )


def aws_enis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the shape of the interface view."""
    rows = _times(flat(spark, sf_dir, "select * from machine"), "window_start", "window_end")
    return rows.select(
        "window_start",
        F.col("ip_address").alias("private_ip"),
        "eni_id",
        "account_id",
        F.lit("ec2-instance").alias("object_type"),
        "window_end",
    )


def iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(spark, sf_dir, "select * from ioc")


def aws_beacon_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "select *, host as instanceid from beacon")
    return conform(_times(rows, "recorded_at", "starttime", "endtime"), schemas.AWS_FLOW_LOGS)


def gcp_beacon_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _times(flat(spark, sf_dir, "select * from beacon"), "recorded_at", "starttime", "endtime")
    return rows.select(
        "recorded_at",
        F.col("host").alias("src_vm_name"),
        F.col("srcaddr").alias("src_ip"),
        F.col("dstaddr").alias("dst_ip"),
        F.col("starttime").alias("start_time"),
        F.col("endtime").alias("end_time"),
    )


# Tags as JSON: a list of objects, with a repeated key and an element without a value.
_ROLE = "case n % 4 when 0 then 'apache' when 1 then 'jump_box' when 2 then 'db' end"


def _tag_elements(key: str, value: str) -> str:
    role = f"map('{key}', 'instance_role', '{value}', {_ROLE})"
    others = f"""map('{key}', 'team', '{value}', 'old'),
        map('{key}', 'team', '{value}', concat('t', cast(n % 5 as string))),
        map('{key}', 'orphan')"""
    return f"case when n % 4 <> 3 then array({role}, {others}) else array({others}) end"


def aws_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instance snapshots, with either spelling of tags and launch time, and interface snapshots."""
    first = """named_struct('privateIpAddress', concat('10.20.', cast(((n) div 2) div 250 as string), '.', cast(((n) div 2) % 250 as string)),
                     'networkInterfaceId', concat('eni-', cast(n as string)))"""
    second = """named_struct('privateIpAddress', concat('10.21.0.', cast(n as string)),
                     'networkInterfaceId', concat('eni-b', cast(n as string)))"""
    interfaces = f"""case when n % 11 = 0 then array() when n % 4 = 0 then array({first}, {second})
        else array({first}) end"""
    launched = f"case when launched is not null then {_iso('launched')} end"
    instances = flat(spark, sf_dir, "select * from config_snapshot").selectExpr(
        "account_id",
        "instance_id as resource_id",
        "'AWS::EC2::Instance' as resource_type",
        "recorded_at",
        f"""case when capitals then to_json(named_struct('networkInterfaces', {interfaces},
                 'Tags', {_tag_elements('Key', 'Value')}, 'LaunchTime', {launched}))
            else to_json(named_struct('networkInterfaces', {interfaces},
                 'tags', {_tag_elements('key', 'value')}, 'launchTime', {launched})) end as configuration""",
    )
    enis = flat(spark, sf_dir, "select * from config_eni").selectExpr(
        "account_id",
        "eni_id as resource_id",
        "'AWS::EC2::NetworkInterface' as resource_type",
        "recorded_at",
        "eni_id as network_interface_id",
        "private_ip as private_ip_address",
        "interface_type",
        "description",
        "case when public_name is not null then to_json(named_struct('PublicDnsName', public_name)) end as attachment",
        "case when group_name is not null then to_json(array(named_struct('GroupName', group_name))) end as groups",
        "to_json(array(named_struct('PrivateDnsName', dns_name))) as private_ip_addresses",
    )
    both = instances.unionByName(enis, allowMissingColumns=True)
    return conform(_times(both, "recorded_at"), schemas.AWS_CONFIG)


def cloudtrail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Launches, stops and interface creations."""

    def item(instance: str, address: str, eni: str, shift: int) -> str:
        return f"""named_struct('instanceId', {instance}, 'privateIpAddress', {address},
            'launchTime', (recorded_at + {shift}) * 1000,
            'tagSet', named_struct('items', {_tag_elements('key', 'value')}),
            'networkInterfaceSet', named_struct('items', array(
                named_struct('networkInterfaceId', {eni}, 'privateIpAddress', {address}))))"""

    number = "cast(n as string)"
    pair = "concat('10.{}.', cast((n div 2) div 250 as string), '.', cast((n div 2) % 250 as string))"
    launches = flat(spark, sf_dir, "select * from launch_event").selectExpr(
        "recorded_at - 60 as event_time",
        "recorded_at",
        "account_id as recipient_account_id",
        "'RunInstances' as event_name",
        f"""to_json(named_struct('instancesSet', named_struct('items', array(
            {item(f"concat('i-', {number})", pair.format(20), f"concat('eni-', {number})", -5)},
            {item(f"concat('i-x', {number})", pair.format(22), f"concat('eni-x', {number})", 5)}
        )))) as response_elements""",
    )
    stops = flat(spark, sf_dir, "select * from stop_event").selectExpr(
        "event_time",
        "event_time as recorded_at",
        "account_id as recipient_account_id",
        "event_name",
        f"""to_json(named_struct('instancesSet', named_struct('items', array(
            named_struct('instanceId', concat('i-', {number})),
            named_struct('instanceId', concat('i-x', {number})))))) as response_elements""",
    )
    creations = flat(spark, sf_dir, "select * from create_eni").selectExpr(
        "event_time",
        "event_time as recorded_at",
        "account_id as recipient_account_id",
        "'CreateNetworkInterface' as event_name",
        "error_code",
        "source_ip_address",
        "invoked_by as user_identity_invokedby",
        "principal_id as user_identity_principal_id",
        "to_json(named_struct('description', request_description)) as request_parameters",
        """case when n % 2 = 0
           then to_json(named_struct('networkInterface', named_struct('networkInterfaceId', eni_id, 'privateIpAddress', private_ip), 'instanceId', eni_instance_id))
           else to_json(named_struct('networkInterface', named_struct('networkInterfaceId', eni_id), 'privateIpAddress', private_ip, 'instanceId', eni_instance_id))
           end as response_elements""",
    )
    every = launches.unionByName(stops, allowMissingColumns=True).unionByName(
        creations, allowMissingColumns=True
    )
    return conform(_times(every, "event_time", "recorded_at"), schemas.CLOUDTRAIL)


# Azure resource paths. Ids come in mixed case from the inventory and in upper case from events.
_NIC_PATH = "concat('/subscriptions/sub-', cast(n % 3 as string), '/resourceGroups/RG/providers/Microsoft.Network/networkInterfaces/NIC-', cast(n as string))"
_VM_PATH = "concat('/subscriptions/sub-', cast(n % 3 as string), '/resourceGroups/RG/providers/Microsoft.Compute/virtualMachines/VM-', cast(n as string))"
_NIC_IP = "concat('10.0.', cast((n div 2) div 250 as string), '.', cast((n div 2) % 250 as string))"
_FIRST_IP = f"named_struct('name', 'first', 'properties', named_struct('privateIPAddress', {_NIC_IP}, 'primary', true))"
_SECOND_IP = "named_struct('name', 'second', 'properties', named_struct('privateIPAddress', concat('10.9.9.', cast(n as string)), 'primary', false))"
_NIC_PROPERTIES = f"""named_struct('ipConfigurations', case when n % 19 = 0 then array()
    when n % 5 = 0 then array({_SECOND_IP}, {_FIRST_IP}) else array({_FIRST_IP}) end)"""
_NIC_TAGS = "case when n % 6 = 1 and {version} = 0 then null else named_struct('v', cast({version} as string)) end"
_VM_TAGS = f"case when n % 4 = 3 then null else named_struct('instance_role', {_ROLE}, 'v', cast({{version}} as string)) end"
_VM_NICS = f"""named_struct('networkProfile', named_struct('networkInterfaces',
    case when n % 10 = 0 then array(named_struct('id', {_NIC_PATH}), named_struct('id', concat(upper({_NIC_PATH}), '0')))
    else array(named_struct('id', {_NIC_PATH})) end),
    'osProfile', named_struct('computerName', concat('host-', cast(n as string))))"""


def azure_collect_network_interfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "select * from nic_snapshot").selectExpr(
        "'Tenant-1' as tenant_id",
        "concat('sub-', cast(n % 3 as string)) as subscription_id",
        f"{_NIC_PATH} as id",
        "concat('NIC-', cast(n as string)) as name",
        "'WestEurope' as location",
        "'Microsoft.Network/networkInterfaces' as type",
        "seen_at as recorded_at",
        f"to_json({_NIC_TAGS.format(version='version')}) as tags",
        f"to_json({_NIC_PROPERTIES}) as properties",
    )
    return conform(_times(rows, "recorded_at"), schemas.AZURE_COLLECT_NETWORK_INTERFACES)


def azure_collect_virtual_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "select * from nic_snapshot").selectExpr(
        "'Tenant-1' as tenant_id",
        "concat('sub-', cast(n % 3 as string)) as subscription_id",
        f"{_VM_PATH} as id",
        "concat('host-', cast(n as string)) as name",
        "'WestEurope' as location",
        "seen_at as recorded_at",
        f"to_json({_VM_TAGS.format(version='version')}) as tags",
        f"to_json({_VM_NICS}) as properties",
    )
    return conform(_times(rows, "recorded_at"), schemas.AZURE_COLLECT_VIRTUAL_MACHINES)


def azure_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creations and deletions of NICs and VMs."""

    def body(path: str, kind: str, tags: str, properties: str) -> str:
        return f"""to_json(named_struct('entity', upper({path}), 'responseBody', to_json(named_struct(
            'id', upper({path}), 'name', concat('NIC-', cast(n as string)), 'location', 'WESTEUROPE',
            'type', '{kind}', 'tags', {tags}, 'properties', {properties}))))"""

    created = flat(spark, sf_dir, "select * from nic_created")
    nics = created.selectExpr(
        "seen_at as event_time",
        "seen_at as recorded_at",
        "'MICROSOFT.NETWORK/NETWORKINTERFACES/WRITE' as operation_name",
        "'Write' as category",
        "signature as result_signature",
        "'Success' as result_type",
        f"upper({_NIC_PATH}) as resource_id",
        "to_json(named_struct('tenantId', 'TENANT-1')) as raw",
        body(_NIC_PATH, "Microsoft.Network/networkInterfaces", _NIC_TAGS.format(version="2"), _NIC_PROPERTIES)
        + " as properties",
    )
    vms = created.selectExpr(
        "seen_at as event_time",
        "seen_at as recorded_at",
        "'MICROSOFT.COMPUTE/VIRTUALMACHINES/WRITE' as operation_name",
        "'Write' as category",
        "case when signature = 'Failed' then 'Failed' else 'Accepted.Created' end as result_signature",
        "'Accept' as result_type",
        f"upper({_VM_PATH}) as resource_id",
        "to_json(named_struct('tenantId', 'Tenant-1')) as raw",
        body(_VM_PATH, "Microsoft.Compute/virtualMachines", _VM_TAGS.format(version="2"), _VM_NICS)
        + " as properties",
    )
    deleted = flat(spark, sf_dir, "select * from nic_deleted")
    ends = [
        deleted.selectExpr(
            "event_time",
            "event_time as recorded_at",
            f"'MICROSOFT.{operation}/DELETE' as operation_name",
            "'Delete' as category",
            "'Succeeded.' as result_signature",
            "result_type",
            f"upper({path}) as resource_id",
            "cast(null as string) as raw",
            f"to_json(named_struct('entity', upper({path}))) as properties",
        )
        for operation, path in (
            ("NETWORK/NETWORKINTERFACES", _NIC_PATH),
            ("COMPUTE/VIRTUALMACHINES", _VM_PATH),
        )
    ]
    every = nics.unionByName(vms).unionByName(ends[0]).unionByName(ends[1])
    return conform(_times(every, "event_time", "recorded_at"), schemas.AZURE_LOGS)


def azure_flow_logs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per flow: two rules, one MAC group each."""
    letters = "case protocol when 6 then 'T' when 17 then 'u' else 'x' end"
    direction = "case when l_linenumber % 3 = 0 then 'I' else 'o' end"
    decision = "case when action = 'REJECT' then 'D' else 'a' end"
    ends = "srcaddr, dstaddr, cast(srcport as string), cast(dstport as string)"
    begin = f"concat_ws(',', cast(starttime as string), {ends}, {letters}, {direction}, 'A', 'B', '', '', '', '')"
    end = f"""concat_ws(',', cast(endtime as string), {ends}, {letters}, {direction}, 'a', 'E',
              cast(packets as string), cast(bytes as string), cast(packets + 1 as string), cast(bytes + 1 as string))"""
    third = f"concat_ws(',', cast(starttime as string), {ends}, {letters}, {direction}, {decision}, ' c')"
    rows = flat(spark, sf_dir, "select * from flow").selectExpr(
        "recorded_at",
        f"""to_json(named_struct(
            'category', 'NetworkSecurityGroupFlowEvent', 'macAddress', '000D3AF87856',
            'operationName', 'NetworkSecurityGroupFlowEvents',
            'resourceId', concat('/SUBSCRIPTIONS/SUB-', cast(l_suppkey % 3 as string), '/RESOURCEGROUPS/RG'),
            'systemId', 'sys-1', 'time', {_iso('recorded_at')},
            'properties', named_struct('Version', 2, 'flows', array(
                named_struct('rule', 'allow-web', 'flows', array(
                    named_struct('mac', '000D3AF87856', 'flow_tuples', array({begin}, {end})))),
                named_struct('rule', 'other', 'flows', array(
                    named_struct('mac', '000D3AF87857', 'flow_tuples',
                        case when l_orderkey % 7 = 0 then array() else array({third}) end))))))) as flow_raw""",
    )
    return apart(_times(rows, "recorded_at"), "flow_raw")


_GCP_PROJECT = "concat('p', cast(n % 2 as string))"


def _gcp_resource(project: str) -> str:
    return f"concat('projects/', {project}, '/zones/z1/instances/vm-', cast(n as string))"


def gcp_flow_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "select * from gcp_flow").selectExpr(
        "recorded_at",
        "'compute.googleapis.com/vpc_flows' as log_type",
        "'acct' as account",
        "concat('log-', cast(l_orderkey as string)) as id",
        "'prod' as deployment",
        f"""to_json(named_struct('timestamp', {_iso('endtime')}, 'insertId', concat('x', cast(l_partkey as string)),
            'jsonPayload', named_struct(
                'start_time', {_iso('starttime')}, 'end_time', {_iso('gcp_end')},
                'connection', named_struct('src_ip', srcaddr, 'src_port', srcport, 'dest_ip', dstaddr,
                                           'dest_port', dstport, 'protocol', protocol),
                'bytes_sent', cast(gcp_bytes as string), 'packets_sent', cast(packets as string),
                'src_instance', named_struct('project_id', 'p0', 'region', 'r1', 'zone', 'z1',
                    'vm_name', case when l_linenumber % 3 = 0 then other_vm else own_vm end),
                'dest_instance', named_struct('project_id', 'p0', 'region', 'r1', 'zone', 'z1',
                    'vm_name', case when l_linenumber % 3 = 0 then own_vm else other_vm end),
                'src_vpc', named_struct('subnetwork_name', 'sn-a'), 'dest_vpc', named_struct('subnetwork_name', 'sn-b'),
                'reporter', case when l_linenumber % 3 = 0 then 'DEST' else 'SRC' end))) as raw""",
    )
    return apart(conform(_times(rows, "recorded_at"), schemas.GCP_AUDIT_LOGS), "raw")


def gcp_audit_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow entries, creations and deletions, as they come: in one table."""
    created = flat(spark, sf_dir, "select * from gcp_created").selectExpr(
        "recorded_at",
        "'cloudaudit.googleapis.com/activity' as log_type",
        "'acct' as account",
        f"""to_json(named_struct('receiveTimestamp', {_iso('recorded_at')},
            'resource', named_struct('type', 'gce_instance', 'labels', named_struct('project_id', {_GCP_PROJECT}, 'zone', 'z1')),
            'protoPayload', named_struct('resourceName', {_gcp_resource(_GCP_PROJECT)}, 'methodName', 'v1.compute.instances.insert',
                'request', named_struct('name', concat('vm-', cast(n as string)),
                    'labels', case when n % 8 = 7 then null else {_tag_elements('key', 'value')} end),
                'response', named_struct('startTime', {_iso('start_time')}, 'operationType', 'insert')))) as raw""",
    )
    deleted = flat(spark, sf_dir, "select * from gcp_deleted").selectExpr(
        "recorded_at",
        "'cloudaudit.googleapis.com/activity' as log_type",
        "'acct' as account",
        f"""to_json(named_struct('receiveTimestamp', {_iso('recorded_at')},
            'resource', named_struct('type', 'gce_instance', 'labels', named_struct('project_id', {_GCP_PROJECT}, 'zone', 'z1')),
            'protoPayload', named_struct('resourceName', {_gcp_resource(_GCP_PROJECT)}, 'methodName', 'v1.compute.instances.delete',
                'response', named_struct('operationType', operation)))) as raw""",
    )
    events = _times(created.unionByName(deleted), "recorded_at")
    return gcp_flow_entries(spark, sf_dir).unionByName(conform(events, schemas.GCP_AUDIT_LOGS))


def gcp_cloud_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots. Every tenth machine also exists in another project under the same name."""
    project = f"case when n % 10 = 0 and form = 2 then 'other' else {_GCP_PROJECT} end"
    rows = flat(spark, sf_dir, "select * from gcp_snapshot").selectExpr(
        "recorded_at",
        "'cloudassets' as log_type",
        "'acct' as account",
        f"""to_json(named_struct('name', concat('//compute.googleapis.com/', {_gcp_resource(project)}),
            'asset_type', 'compute.googleapis.com/Instance',
            'resource', named_struct('location', 'z1', 'data', named_struct(
                'labels', case when n % 4 = 3 then null else map('instance_role', {_ROLE}, 'team', concat('t', cast(n % 5 as string))) end,
                'networkInterfaces', array(named_struct('networkIP', concat('10.40.0.', cast(n as string)))),
                'creationTimestamp', {_iso('start_time')})))) as raw""",
    )
    return conform(_times(rows, "recorded_at"), schemas.GCP_CLOUD_ASSETS)


# All of the above that stand for a table of their own.
INPUTS = """aws_flow_logs_raw aws_instances aws_enis iocs aws_beacon_flows gcp_beacon_flows aws_config cloudtrail
    azure_collect_network_interfaces azure_collect_virtual_machines azure_logs azure_flow_logs_raw gcp_audit_logs
    gcp_cloud_assets""".split()
