"""Source schemas. Nested columns are JSON text at the boundary.

Column order and names are fixed values: they are those of the sources.
"""

from __future__ import annotations

AWS_FLOW_LOGS = """
    recorded_at timestamp, account string, version int, accountid string, instanceid string,
    interfaceid string, azid string, region string, vpcid string, subnetid string,
    sublocationid string, sublocationtype string, action string, srcaddr string, srcport int,
    dstaddr string, dstport int, protocol int, packets bigint, bytes bigint,
    starttime timestamp, endtime timestamp, pktsrcaddr string, pktdstaddr string, tcpflags int,
    type string, logstatus string, pkt_src_aws_service string, pkt_dst_aws_service string,
    flow_direction string, traffic_path int
"""

AWS_CONFIG = """
    account_id string, resource_id string, resource_type string, recorded_at timestamp,
    configuration string, network_interface_id string, private_ip_address string,
    interface_type string, description string, attachment string, groups string,
    private_ip_addresses string
"""

CLOUDTRAIL = """
    event_time timestamp, recorded_at timestamp, recipient_account_id string, event_name string,
    error_code string, source_ip_address string, user_identity_invokedby string,
    user_identity_principal_id string, request_parameters string, response_elements string
"""

AZURE_LOGS = """
    event_time timestamp, recorded_at timestamp, operation_name string, category string,
    result_signature string, result_type string, resource_id string, raw string, properties string
"""

AZURE_COLLECT_NETWORK_INTERFACES = """
    tenant_id string, subscription_id string, id string, name string, location string,
    type string, recorded_at timestamp, tags string, properties string
"""

AZURE_COLLECT_VIRTUAL_MACHINES = """
    tenant_id string, subscription_id string, id string, name string, location string,
    recorded_at timestamp, tags string, properties string
"""

AZURE_FLOW_LOGS_RAW = "recorded_at timestamp, flow_raw string"

GCP_AUDIT_LOGS = """
    recorded_at timestamp, log_type string, account string, id string, deployment string,
    raw string
"""

GCP_CLOUD_ASSETS = "recorded_at timestamp, log_type string, account string, raw string"

IOCS = "ioc_value string"

SOURCES = {
    "aws_flow_logs_raw": AWS_FLOW_LOGS,
    "aws_config": AWS_CONFIG,
    "cloudtrail": CLOUDTRAIL,
    "azure_logs": AZURE_LOGS,
    "azure_collect_network_interfaces": AZURE_COLLECT_NETWORK_INTERFACES,
    "azure_collect_virtual_machines": AZURE_COLLECT_VIRTUAL_MACHINES,
    "azure_flow_logs_raw": AZURE_FLOW_LOGS_RAW,
    "gcp_audit_logs": GCP_AUDIT_LOGS,
    "gcp_cloud_assets": GCP_CLOUD_ASSETS,
    "iocs": IOCS,
}

# What the JSON text decodes to.
AZURE_FLOW_RECORD = """
    category string, macAddress string, operationName string, resourceId string,
    systemId string, time string,
    properties struct<
        Version: int,
        flows: array<struct<
            rule: string,
            flows: array<struct<mac: string, flow_tuples: array<string>, flowTuples: array<string>>>
        >>
    >
"""

GCP_FLOW_RECORD = """
    timestamp string, insertId string,
    jsonPayload struct<
        start_time: string, end_time: string,
        connection: struct<src_ip: string, src_port: string, dest_ip: string, dest_port: string, protocol: string>,
        bytes_sent: string, packets_sent: string,
        src_instance: struct<project_id: string, region: string, vm_name: string, zone: string>,
        dest_instance: struct<project_id: string, region: string, vm_name: string, zone: string>,
        src_vpc: struct<subnetwork_name: string>, dest_vpc: struct<subnetwork_name: string>,
        reporter: string
    >
"""

GCP_AUDIT_RECORD = """
    receiveTimestamp string,
    resource struct<type: string, labels: struct<project_id: string, zone: string>>,
    protoPayload struct<
        resourceName: string, methodName: string,
        request: struct<name: string, labels: array<map<string, string>>>,
        response: struct<startTime: string, operationType: string>
    >
"""

GCP_ASSET_RECORD = """
    name string, asset_type string,
    resource struct<
        location: string,
        data: struct<labels: map<string, string>, networkInterfaces: string, creationTimestamp: string>
    >
"""

# JSON text in the columns of each source, and what it decodes to where that is declared.
PAYLOADS = {
    "aws_config": dict.fromkeys(["configuration", "attachment"]),
    "cloudtrail": dict.fromkeys(["request_parameters", "response_elements"]),
    "azure_logs": dict.fromkeys(["raw", "properties"]),
    "azure_collect_network_interfaces": dict.fromkeys(["tags", "properties"]),
    "azure_collect_virtual_machines": dict.fromkeys(["tags", "properties"]),
    "azure_flow_logs_raw": {"flow_raw": AZURE_FLOW_RECORD},
    "gcp_audit_logs": {"raw": None},
    "gcp_cloud_assets": {"raw": GCP_ASSET_RECORD},
}
