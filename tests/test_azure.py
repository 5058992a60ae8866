import json
import re

import pytest
from conftest import NOW, as_set, carried, optimized, plan_of
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import in_window
from flowspark.operators import (
    azure_denied_baseline,
    azure_denied_flows,
    azure_denied_records,
    azure_flow_logs,
    azure_flow_logs_join_vm_nics,
    azure_nics,
    azure_port_scanning,
    azure_vms,
    azure_vms_nics,
)
from workload import inputs, queries

SMALL = "/root/testdata/sf0.001"


def nic_row(nic, at, ips=("10.0.0.1",), tags=None, **extra):
    configs = [{"properties": {"privateIPAddress": ip, "primary": n == 0}} for n, ip in enumerate(ips)]
    return {
        "tenant_id": "T", "subscription_id": "S", "id": nic, "name": nic, "location": "L", "type": "X",
        "recorded_at": at, "tags": json.dumps(tags) if tags else None,
        "properties": json.dumps({"ipConfigurations": configs}), **extra,
    }


def deletion(operation, category, at, **extra):
    return {
        "event_time": at, "recorded_at": at, "operation_name": operation, "category": category,
        "result_signature": "Succeeded.", "result_type": "Success", **extra,
    }


def nic_deletion(nic, at):
    return deletion("MICROSOFT.NETWORK/NETWORKINTERFACES/DELETE", "Delete", at, properties=json.dumps({"entity": nic}))


def test_nic_with_two_ip_configurations(rows):
    inventory = rows(schemas.AZURE_COLLECT_NETWORK_INTERFACES, nic_row("N1", "2024-01-10 00:00:00", ("10.0.0.1", "10.0.0.2")))
    logs = rows(schemas.AZURE_LOGS)
    assert [r.private_ip for r in azure_nics(logs, inventory, now=NOW).collect()] == ["10.0.0.1"]
    both = azure_nics(logs, inventory, now=NOW, keep_all_ips=True)
    assert sorted(r.private_ip for r in both.collect()) == ["10.0.0.1", "10.0.0.2"]


def test_untagged_version_ranks_first_and_address_passes_on(rows):
    inventory = rows(
        schemas.AZURE_COLLECT_NETWORK_INTERFACES,
        nic_row("N1", "2024-01-10 00:00:00", tags={"a": "1"}),
        nic_row("N1", "2024-01-12 00:00:00"),
        nic_row("n1", "2024-01-08 00:00:00", ips=()),
        nic_row("N2", "2024-01-20 00:00:00", tags={"a": "2"}),
        nic_row("N3", "2024-01-21 00:00:00", ips=("10.0.0.3",)),
    )
    logs = rows(schemas.AZURE_LOGS, nic_deletion("N3", "2024-01-25 00:00:00"), nic_deletion("N3", "2024-01-26 00:00:00"))
    got = azure_nics(logs, inventory, now=NOW).select(
        "nic_id", "nic_tags", *[F.col(c).cast("string") for c in ("earliest", "window_start", "window_end")]
    )
    assert sorted(map(tuple, got.collect())) == [
        # The version without addresses still dates the first sighting.
        ("n1", None, "2024-01-12 00:00:00", "2024-01-08 00:00:00", "2024-01-20 00:00:00"),
        ("n2", {"a": "2"}, "2024-01-20 00:00:00", "2024-01-20 00:00:00", None),
        ("n3", None, "2024-01-21 00:00:00", "2024-01-21 00:00:00", "2024-01-25 00:00:00"),
        ("n3", None, "2024-01-21 00:00:00", "2024-01-21 00:00:00", "2024-01-26 00:00:00"),
    ]


def vm_row(vm, at, nics=("N1",), tags=None):
    return {
        "tenant_id": "T", "subscription_id": "S", "id": vm, "name": vm, "location": "L", "recorded_at": at,
        "tags": json.dumps(tags) if tags else None,
        "properties": json.dumps({"networkProfile": {"networkInterfaces": [{"id": n} for n in nics]}}),
    }


def test_vms_and_their_nics(rows):
    inventory = rows(
        schemas.AZURE_COLLECT_VIRTUAL_MACHINES,
        vm_row("VM1", "2024-01-10 00:00:00", ("N1", "n2", "gone")),
        vm_row("VM1", "2024-01-12 00:00:00", ("N1", "n2", "gone")),
        vm_row("VM2", "2024-01-12 00:00:00"),
        vm_row("VM2", "2024-01-13 00:00:00", tags={"instance_role": "db"}),
    )
    logs = rows(schemas.AZURE_LOGS, deletion("MICROSOFT.COMPUTE/VIRTUALMACHINES/DELETE", "Delete", "2024-01-20 00:00:00", resource_id="vm1"))
    vms = azure_vms(logs, inventory, now=NOW)
    got = vms.select("vm_id", "tags", F.col("window_start").cast("string"), F.col("window_end").cast("string"))
    assert sorted(map(tuple, got.collect()), key=repr) == [
        ("vm1", None, "2024-01-10 00:00:00", "2024-01-20 00:00:00"),
        ("vm2", None, "2024-01-12 00:00:00", "2024-01-12 00:00:00"),
        ("vm2", {"instance_role": "db"}, "2024-01-12 00:00:00", "2024-01-13 00:00:00"),
    ]
    nics = azure_nics(
        rows(schemas.AZURE_LOGS),
        rows(schemas.AZURE_COLLECT_NETWORK_INTERFACES, nic_row("N1", "2024-01-10 00:00:00"), nic_row("N2", "2024-01-10 00:00:00")),
        now=NOW,
    )
    pairs = azure_vms_nics(vms, nics).select("vm_id", "nic_id").collect()
    assert sorted(map(tuple, pairs)) == [("vm1", "n1"), ("vm1", "n2"), ("vm2", "n1"), ("vm2", "n1")]


def test_flow_tuples(rows):
    record = {
        "category": "C", "macAddress": "M", "resourceId": "/S/x", "time": "2024-01-30T10:00:00Z",
        "properties": {"flows": [
            {"rule": "r1", "flows": [{"mac": "m1", "flow_tuples": [
                "1706608800,1.1.1.1,2.2.2.2,10,20,T,I,A,B,,,,",
                "1706608801,1.1.1.1,2.2.2.2,10,20,u, o ,d,e,1,2,3,4",
                "1706608802,1.1.1.1",
            ]}]},
            {"rule": "r2", "flows": [{"mac": "m2", "flowTuples": ["x,3.3.3.3,2.2.2.2,a,20,z,z,z,z"]}]},
            {"rule": "r3", "flows": []},
        ]},
    }
    raw = rows(schemas.AZURE_FLOW_LOGS_RAW, {"recorded_at": "2024-01-30 10:01:00", "flow_raw": json.dumps(record)},
               {"recorded_at": "2024-01-30 10:01:00", "flow_raw": "{broken"}, {"flow_raw": None})
    names = ["rule", "flow_mac", "src_addr", "dst_addr", "src_port", "dst_port", "protocol", "traffic_flow",
             "traffic_decision", "flow_state", "packets_src_to_dst", "bytes_dst_to_src"]
    flows = azure_flow_logs(raw)
    got = flows.select(F.unix_seconds("event_time").alias("at"), *names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        (1706608800, "r1", "m1", "1.1.1.1", "2.2.2.2", 10, 20, "TCP", "INBOUND", "ALLOWED", "BEGIN", None, None),
        (1706608801, "r1", "m1", "1.1.1.1", "2.2.2.2", 10, 20, "UDP", "OUTBOUND", "DENIED", "END", 1, 4),
        (1706608802, "r1", "m1", "1.1.1.1", None, None, None, None, None, None, None, None, None),
        (None, "r2", "m2", "3.3.3.3", "2.2.2.2", None, 20, None, None, None, None, None, None),
    ], key=repr)
    texts = flows.where("rule = 'r1'").select("properties", "flow_raw", "flow_tuples").first()
    assert len(json.loads(texts.properties)["flows"]) == 3
    assert json.loads(texts.flow_raw)["rule"] == "r1" and json.loads(texts.flow_tuples)["mac"] == "m1"
    assert flows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


VMS_NICS = """nic_id string, nic_name string, nic_location string, nic_properties string, nic_tags map<string,string>,
    ip_configuration string, private_ip string, subscription_id string, window_start timestamp, window_end timestamp,
    vm_tags map<string,string>, vm_id string, vm_name string, vm_properties string"""
FLOWS = """recorded_at timestamp, time_stamp timestamp, event_time timestamp, mac_address string, resource_id string,
    rule string, src_addr string, dst_addr string, src_port int, dst_port int, protocol string, traffic_flow string,
    traffic_decision string, flow_state string, packets_src_to_dst bigint, bytes_src_to_dst bigint,
    packets_dst_to_src bigint, bytes_dst_to_src bigint"""


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_enriched_flows_equal_the_literal_distinct_join(rows, limit):
    entity = lambda n, ip, start, end, sub="sub", **kw: {
        "nic_id": f"n{n}", "private_ip": ip, "subscription_id": sub, "window_start": f"2024-01-{start:02d}",
        "window_end": end and f"2024-01-{end:02d}", "vm_id": f"v{n}", "vm_tags": {"instance_role": "db"}, **kw}
    entities = rows(
        VMS_NICS,
        entity(1, "10.0.0.1", 1, 10), entity(1, "10.0.0.1", 1, 12), entity(1, "10.0.0.1", 11, None),
        entity(1, "10.0.0.1", 1, 10, vm_tags=None), entity(2, "10.0.0.1", 9, None, "other"), entity(3, "10.0.0.2", 5, 8),
    )
    flow = lambda day, src, dst, **kw: {
        "recorded_at": "2024-01-30", "event_time": f"2024-01-{day:02d}", "src_addr": src, "dst_addr": dst,
        "resource_id": "/SUBSCRIPTIONS/SUB/x", **kw}
    flows = rows(
        FLOWS,
        *[flow(d, "10.0.0.1", "10.0.0.2") for d in (3, 6, 6, 9, 11, 20)],
        *[flow(d, "10.0.0.2", "10.0.0.1") for d in (3, 6, 9, 11, 20)],
        flow(6, None, "10.0.0.1"), flow(6, "10.0.0.1", "10.0.0.1", resource_id=None),
    )
    got = azure_flow_logs_join_vm_nics(flows, entities, broadcast_limit=limit)
    keep = ["event_time", "src_addr", "dst_addr", "resource_id", "src_nic_id", "src_vm_id", "src_role", "dst_nic_id", "dst_vm_id", "dst_role"]
    got = got.withColumn("src_role", F.col("src_vm_tags.instance_role")).withColumn("dst_role", F.col("dst_vm_tags.instance_role")).select(*keep)
    side = lambda s: entities.select(
        F.col("private_ip").alias(f"{s}_ip"), F.col("subscription_id").alias(f"{s}_sub"), F.col("window_start").alias(f"{s}_s"),
        F.col("window_end").alias(f"{s}_e"), F.col("nic_id").alias(f"{s}_nic_id"), F.col("vm_id").alias(f"{s}_vm_id"),
        F.col("vm_tags.instance_role").alias(f"{s}_role"))
    alive = lambda s: in_window(F.col("event_time"), F.col(f"{s}_s"), F.col(f"{s}_e"))
    literal = (
        flows.join(side("src"), (F.col("src_addr") == F.col("src_ip")) & alive("src") & (F.lower(F.split("resource_id", "/")[2]) == F.col("src_sub")), "left")
        .join(side("dst"), (F.col("dst_addr") == F.col("dst_ip")) & alive("dst"), "left")
        .select(*keep).distinct()
    )
    assert as_set(got) == as_set(literal)


def test_denied_baseline_and_scan(rows):
    vms = rows("tags map<string,string>, window_end timestamp",
               *[{"tags": {"instance_role": "db"}, "window_end": "2024-01-30 12:00:00"}] * 2)
    flow = lambda at, **kw: {
        "flow_recorded_at": at, "traffic_decision": "DENIED", "src_vm_id": "v1", "src_vm_tags": {"instance_role": "db"}, **kw}
    past = [flow(f"2024-01-30 {h:02d}:10:00") for h in (1, 2, 2, 2)] + [flow("2024-01-30 03:00:00", src_vm_tags={})]
    last = [flow("2024-01-30 23:10:00")] * 3 + [flow("2024-01-31 00:00:00")]
    flows = rows("flow_recorded_at timestamp, traffic_decision string, src_vm_id string, src_vm_tags map<string,string>",
                 *past, *last, flow("2024-01-30 23:10:00", traffic_decision="ALLOWED"))
    baseline = azure_denied_baseline(flows, vms, now=NOW)
    got = {r.src_role: (r.avg_denied_count, r.stddev_denied_count) for r in baseline.collect()}
    assert got[None] == (None, None)
    assert got["db"] == (1.0, pytest.approx(0.7071067811865476))
    found = azure_port_scanning(flows, baseline, now=NOW).collect()
    assert [(r.src_vm_id, r.role_denied_count) for r in found] == [("v1", 3)]
    assert azure_port_scanning(flows, baseline, now=NOW, k=5).count() == 0


def test_properties_come_late(rows):
    """No exchange, sort or window has properties of NICs or VMs above their digests."""
    logs = rows(schemas.AZURE_LOGS)
    nics = azure_nics(logs, rows(schemas.AZURE_COLLECT_NETWORK_INTERFACES, nic_row("N1", "2024-01-10 00:00:00")), now=NOW)
    vms = azure_vms(logs, rows(schemas.AZURE_COLLECT_VIRTUAL_MACHINES, vm_row("VM1", "2024-01-10 00:00:00")), now=NOW)
    names = ("properties", "nic_properties", "payload", "doc")
    assert carried(nics, *names) == [] and carried(vms, *names) == []
    assert "max(payload" not in optimized(nics.drop("nic_properties", "ip_configuration")) and "max(payload" in optimized(nics)


def test_same_properties_in_other_words_are_one_version(rows):
    text = '{{"networkProfile":{{"networkInterfaces":[]}},"a":{}}}'
    spaced = '{ "a":1, "networkProfile": {"networkInterfaces": []} }'
    inventory = rows(
        schemas.AZURE_COLLECT_VIRTUAL_MACHINES,
        {**vm_row("VM1", "2024-01-10 00:00:00"), "properties": text.format(1)},
        {**vm_row("VM1", "2024-01-11 00:00:00"), "properties": spaced},
        {**vm_row("VM1", "2024-01-12 00:00:00"), "properties": text.format(2)},
    )
    got = azure_vms(rows(schemas.AZURE_LOGS), inventory, now=NOW).select("properties", F.col("window_end").cast("string")).collect()
    assert sorted(map(tuple, got)) == [
        ('{"a":1,"networkProfile":{"networkInterfaces":[]}}', "2024-01-11 00:00:00"),
        ('{"a":2,"networkProfile":{"networkInterfaces":[]}}', "2024-01-12 00:00:00"),
    ]


@pytest.mark.parametrize("name", ["azure_flow_logs_raw", "gcp_audit_logs"])
def test_records_are_built_apart_from_their_parser(spark, name):
    raw = getattr(inputs, name)(spark, SMALL)
    text = "flow_raw" if "flow_raw" in raw.columns else "raw"
    lines = optimized(raw.select(F.from_json(text, "category string, insertId string").alias("r"))).splitlines()
    assert not any("from_json" in line and "concat" in line and "10.0." in line for line in lines)
    assert not [line for line in lines if "from_json" in line and "srcaddr" in line]


@pytest.mark.parametrize(
    "name", ["azure_logs", "azure_collect_network_interfaces", "azure_collect_virtual_machines", "aws_config", "cloudtrail"]
)
def test_records_are_built_by_compiled_expressions(spark, name):
    assert "lambdafunction" not in optimized(getattr(inputs, name)(spark, SMALL))


@pytest.mark.parametrize("name", ["azure_denied_baseline", "azure_port_scanning"])
def test_denied_flows_alone_are_enriched(spark, monkeypatch, name):
    seen, join = [], queries.op.azure_flow_logs_join_lifetimes
    monkeypatch.setattr(
        queries.op, "azure_flow_logs_join_lifetimes", lambda flows, *more: seen.append(flows) or join(flows, *more)
    )
    queries.QUERIES[name](spark, SMALL)
    assert [r[0] for r in seen[0].select("traffic_decision").distinct().collect()] == ["DENIED"]


def test_versions_of_nics_are_sorted_once(rows):
    nics = azure_nics(rows(schemas.AZURE_LOGS, {}), rows(schemas.AZURE_COLLECT_NETWORK_INTERFACES, {}), now=NOW)
    lines = plan_of(nics).splitlines()
    chosen = [n for n, line in enumerate(lines) if re.search(r"SortAggregate\(key=\[nic_id#\d+\], functions=\[partial", line)]
    assert chosen
    for n in chosen:
        below = next(line for line in lines[n + 1 :] if "Project" not in line)
        assert "SortAggregate" in below, below


def test_records_without_denied_flows_are_not_parsed(rows):
    """However the decision is written; what the text leaves open is parsed."""
    def record(n, tuple_text, quote='"'):
        tuples = f"[{quote}{tuple_text}{quote}]"
        text = f'{{"resourceId":"/s/{n}","properties":{{"flows":[{{"rule":"deny, D","flows":[{{"mac":"d","flow_tuples":{tuples}}}]}}]}}}}'
        return {"recorded_at": "2024-01-30 00:00:00", "flow_raw": text}

    start = "1706572800,10.0.0.1,10.0.0.2,1,2,T,I,"
    denied = [record(1, start + "D,B"), record(2, start + " d "), record(3, start + "d", "'"), record(4, start + "\\u0044,B"), record(5, start + "  D ,e,1")]
    others = [record(6, start + "A,B"), record(7, start + " c"), record(8, "d,D"), {"flow_raw": None}, {"flow_raw": "no json"}]
    raw = rows(schemas.AZURE_FLOW_LOGS_RAW, *denied, *others)
    found = azure_denied_flows(azure_flow_logs(azure_denied_records(raw)))
    assert as_set(found) == as_set(azure_denied_flows(azure_flow_logs(raw))) and found.count() == 5
    plain = rows(schemas.AZURE_FLOW_LOGS_RAW, *[{**r, "flow_raw": (r["flow_raw"] or "").replace("deny, D", "deny")} for r in (denied + others)])
    assert sorted(r.flow_raw.split("/s/")[1][0] for r in azure_denied_records(plain).collect()) == ["1", "2", "3", "4", "5", "8"]


@pytest.mark.parametrize("name", ["azure_denied_baseline", "azure_denied_baseline_rolling", "azure_port_scanning"])
def test_denied_queries_parse_few_records(spark, monkeypatch, name):
    seen, parse = [], queries.op.azure_flow_logs
    monkeypatch.setattr(queries.op, "azure_flow_logs", lambda raw: seen.append(raw) or parse(raw))
    queries.QUERIES[name](spark, SMALL)
    every = inputs.azure_flow_logs_raw(spark, SMALL).count()
    assert len(seen) == 1 and 0 < seen[0].count() < every / 4
