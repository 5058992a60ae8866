import json

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.operators import (
    gcp_connect_baseline,
    gcp_flow_logs,
    gcp_flow_logs_join_vms,
    gcp_ioc_connections,
    gcp_port_scanning,
    gcp_vms,
    universal_flow_log,
)

ACTIVITY = "cloudaudit.googleapis.com/activity"


def activity(name, at, operation, labels=None, start=None, project="p"):
    method = {"insert": "v1.compute.instances.insert", "delete": "v1.compute.instances.delete"}[operation]
    record = {
        "receiveTimestamp": at.replace(" ", "T") + "Z",
        "resource": {"type": "gce_instance", "labels": {"project_id": project, "zone": "z"}},
        "protoPayload": {
            "resourceName": f"projects/{project}/zones/z/instances/{name}", "methodName": method,
            "request": {"name": name, "labels": labels}, "response": {"operationType": operation, "startTime": start},
        },
    }
    return {"recorded_at": at, "log_type": ACTIVITY, "account": "a", "raw": json.dumps(record)}


def asset(name, at, labels=None, created=None, project="p"):
    record = {
        "name": f"//compute.googleapis.com/projects/{project}/zones/z/instances/{name}",
        "asset_type": "compute.googleapis.com/Instance",
        "resource": {"location": "z", "data": {"labels": labels, "networkInterfaces": [{"networkIP": "10.0.0.1"}], "creationTimestamp": created}},
    }
    return {"recorded_at": at, "log_type": "cloudassets", "account": "a", "raw": json.dumps(record)}


def test_vms(rows):
    logs = rows(
        schemas.GCP_AUDIT_LOGS,
        activity("one", "2024-01-20 00:00:00", "insert", [{"key": "instance_role", "value": "db"}], "2024-01-19T16:00:00-08:00"),
        activity("two", "2024-01-20 00:00:00", "insert", None, "2024-01-19T16:00:00-08:00"),
        activity("three", "2024-01-10 00:00:00", "insert", None, "2024-01-09T00:00:00Z"),
        activity("three", "2024-01-30 00:00:00", "delete"),
        {"recorded_at": "2024-01-30 00:00:00", "log_type": ACTIVITY, "raw": "{broken"},
    )
    assets = rows(
        schemas.GCP_CLOUD_ASSETS,
        asset("three", "2024-01-29 00:00:00", {"instance_role": "web"}, "2024-01-09T00:00:00Z"),
        asset("four", "2024-01-29 00:00:00"),
        asset("five", "2024-01-20 00:00:00"),
    )
    times = [F.col(c).cast("string") for c in ("earliest", "last_seen", "term_time")]
    got = {r.vm_name: r for r in gcp_vms(logs, assets, now=NOW).select("vm_name", "resource_name", "project_name", "tags", "nics", *times).collect()}
    # "one" and "two" have equal times and no interfaces, and stay two; "five" is older than the snapshots kept.
    assert set(got) == {"one", "two", "three", "four"}
    assert (got["one"].tags, got["two"].tags) == ({"instance_role": "db"}, None)
    assert got["one"].earliest == "2024-01-20 00:00:00"
    three = got["three"]
    assert three.tags == {"instance_role": "web"} and json.loads(three.nics) == [{"networkIP": "10.0.0.1"}]
    assert (three.earliest, three.last_seen, three.term_time) == ("2024-01-09 00:00:00", "2024-01-30 00:00:00", "2024-01-30 00:00:00")
    assert (three.resource_name, three.project_name) == ("projects/p/zones/z/instances/three", "p")
    assert got["four"].earliest == "2024-01-29 00:00:00" and got["four"].tags is None


def entry(at="2024-01-30 23:30:00", src="one", dst=None, sent="0", seconds=0, **connection):
    start = at.replace(" ", "T") + "Z"
    record = {
        "timestamp": start, "insertId": "x",
        "jsonPayload": {
            "start_time": start, "end_time": at.replace(":00", f":{seconds:02d}", 2)[:17] + f"{seconds:02d}Z" if seconds else start,
            "connection": {"src_ip": "10.0.0.1", "src_port": 5, "dest_ip": "8.8.8.8", "dest_port": 53, "protocol": 17, **connection},
            "bytes_sent": sent, "packets_sent": "3",
            "src_instance": {"vm_name": src}, "dest_instance": {"vm_name": dst} if dst else None,
        },
    }
    return {"recorded_at": at, "log_type": "compute.googleapis.com/vpc_flows", "raw": json.dumps(record)}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_flows_and_join(rows, limit):
    logs = rows(schemas.GCP_AUDIT_LOGS, entry(), entry("2024-01-30 20:00:00"), entry(dst="two", sent="70", protocol=6),
                {"recorded_at": "2024-01-30 23:30:00", "log_type": ACTIVITY, "raw": "{}"})
    flows = gcp_flow_logs(logs, now=NOW)
    assert flows.count() == 2 and len(flows.columns) == 27
    row = flows.where("bytes = 70").first()
    assert (row.src_port, row.dst_port, row.protocol, row.packets, row.dst_vm_name) == (5, 53, 6, 3, "two")
    assert row.start_time == row.event_time
    assert gcp_flow_logs(logs, now=NOW, lookback="25 hours").count() == 3
    vms = rows("vm_name string, tags map<string,string>, nics string",
               {"vm_name": "one", "tags": {"instance_role": "db"}, "nics": "[]"}, {"vm_name": "two"}, {"vm_name": "two"}, {"vm_name": None})
    joined = gcp_flow_logs_join_vms(flows, vms, broadcast_limit=limit)
    assert joined.count() == 3
    assert joined.where("dst_vm_name is null").first().src_tags == {"instance_role": "db"}
    iocs = rows("ioc_value string", {"ioc_value": "8.8.8.8"}, {"ioc_value": "10.0.0.1"})
    assert gcp_ioc_connections(flows, iocs).count() == 4


def test_filters_on_parsed_flows_do_not_parse_again(rows):
    flows = gcp_flow_logs(rows(schemas.GCP_AUDIT_LOGS, entry()), now=NOW).where("bytes = 0 and start_time = end_time")
    assert flows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_miss_baseline_and_scan(rows):
    ddl = """recorded_at timestamp, start_time timestamp, end_time timestamp, bytes bigint, src_vm_name string,
        src_tags map<string,string>, dst_tags map<string,string>"""
    miss = lambda at, **kw: {
        "recorded_at": at, "start_time": at, "end_time": at, "bytes": 0, "src_vm_name": "one",
        "src_tags": {"instance_role": "db"}, "dst_tags": {"instance_role": "web"}, **kw}
    flows = rows(
        ddl, *[miss(f"2024-01-30 {h:02d}:10:00") for h in (1, 2, 2, 2)], miss("2024-01-30 05:00:00", bytes=9),
        miss("2024-01-30 05:00:00", src_tags={"instance_role": "unseen"}),
        *[miss("2024-01-30 23:30:00")] * 4, *[miss("2024-01-30 23:30:00", dst_tags=None)] * 9,
    )
    vms = rows("tags map<string,string>, last_seen timestamp", *[{"tags": {"instance_role": "db"}, "last_seen": "2024-01-30 12:00:00"}] * 3)
    baseline = gcp_connect_baseline(flows, vms, now=NOW)
    assert [tuple(r) for r in baseline.collect()] == [(2.0, pytest.approx(1.4142135623730951), "db", "web")]
    found = gcp_port_scanning(flows, baseline, now=NOW)
    assert [(r.src_vm_name, r.miss_count) for r in found.collect()] == [("one", 4)]
    assert gcp_port_scanning(flows, baseline, now=NOW, k=2).count() == 0


def test_universal_flow_log(rows):
    aws = rows(schemas.AWS_FLOW_LOGS, *[{"protocol": p, "srcport": p} for p in (6, 17, 1, None)])
    gcp = rows("recorded_at timestamp, start_time timestamp, src_ip string, src_port int, dst_ip string, dst_port int, protocol int",
               {"protocol": 17}, {"protocol": 58})
    azure = rows("recorded_at timestamp, event_time timestamp, src_addr string, src_port int, dst_addr string, dst_port int, protocol string",
                 {"protocol": "TCP"}, {"protocol": None})
    got = universal_flow_log(aws, gcp, azure)
    assert got.columns == ["recorded_at", "event_time", "src_addr", "src_port", "dst_addr", "dst_port", "protocol"]
    assert sorted(r.protocol or "" for r in got.collect()) == ["", "TCP", "TCP", "UDP", "UDP"]
