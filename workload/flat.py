"""Flat rows derived from the test tables, in SQL both engines run.

Times are whole seconds since the epoch. The text is DuckDB's; for Spark only `//` changes to `div`.
Each entry may select from the test tables and from earlier entries.
`workload.inputs` shapes these rows into sources; the oracle reads them as they are.
"""

from __future__ import annotations

import re

NOW = 1706659200  # 2024-01-31 00:00:00 UTC
HOUR = 3600
DAY = 86400

ROLE = "case {n} % 4 when 0 then 'apache' when 1 then 'jump_box' when 2 then 'db' end"


def _role(n: str) -> str:
    return ROLE.format(n=n)


def _ip(prefix: str, n: str) -> str:
    """Address of holder pair n // 2: two machines share it in turn."""
    half = f"({n}) // 2"
    return (
        f"concat('{prefix}.', cast(({half}) // 250 as string), '.', cast(({half}) % 250 as string))"
    )


def _id(prefix: str, n: str) -> str:
    return f"concat('{prefix}', cast({n} as string))"


FLAT: dict[str, str] = {}

# One flow per lineitem. The internal end is the machine of the supplier; the other
# end is internal for a quarter of the flows.
FLAT["flow"] = f"""
select {NOW} - h % 90000 as recorded_at, {NOW} - h % 90000 as starttime,
       {NOW} - h % 90000 + l_partkey % 180 as endtime,
       {_id("acct-", "l_suppkey % 3")} as accountid, {_id("i-", "l_suppkey")} as instanceid,
       {_id("eni-", "l_suppkey")} as interfaceid,
       case when l_linenumber % 3 = 0 then other else own end as srcaddr,
       case when l_linenumber % 3 = 0 then own else other end as dstaddr,
       cast(1024 + l_orderkey % 60000 as int) as srcport,
       case l_partkey % 5 when 0 then 443 when 1 then 22 when 2 then 80 when 3 then 3306 else 8080 end as dstport,
       case l_partkey % 3 when 0 then 6 when 1 then 17 else 1 end as protocol,
       cast(l_quantity as bigint) as packets,
       case when l_partkey % 10 = 0 then 0 else cast(floor(l_extendedprice) as bigint) end as bytes,
       case (l_orderkey + l_linenumber) % 4 when 0 then 4 when 1 then 2 when 2 then 3 else 18 end as tcpflags,
       case when (l_suppkey + l_partkey) % 7 = 0 then 'REJECT' else 'ACCEPT' end as action,
       l_orderkey, l_partkey, l_suppkey, l_linenumber
from (select *, l_orderkey*7919 + l_partkey*31 + l_linenumber*101 as h,
             {_ip("10.0", "l_suppkey")} as own,
             case when l_partkey % 4 = 0 then concat('10.0.0.', cast(l_partkey % 5 as string))
                  else concat('203.0.113.', cast(l_partkey % 200 as string)) end as other
      from lineitem) t
"""

# Keys 2n and 2n+1 share an address, the second from 12 hours ago.
FLAT["machine"] = f"""
select {_id("i-", "s_suppkey")} as instance_id, {_id("eni-", "s_suppkey")} as eni_id,
       {_id("acct-", "s_suppkey % 3")} as account_id, {_ip("10.0", "s_suppkey")} as ip_address,
       {_role("s_nationkey")} as instance_role,
       {NOW} - case when s_suppkey % 2 = 0 then 172800 else 43200 end as window_start,
       case when s_suppkey % 2 = 0 then {NOW} - 43200 end as window_end,
       {NOW} - 7200 as latest_available_data
from supplier
"""

FLAT["ioc"] = "select concat('203.0.113.', cast(r_regionkey as string)) as ioc_value from region"

# 240 connections per host, two minutes apart, of which the look-back keeps half. Every fourth
# host keeps the beat, the others jitter. Each third host has two addresses.
FLAT["beacon"] = f"""
select {_id("i-", "host")} as host, starttime as recorded_at, starttime,
       starttime + cast(floor(value) as bigint) * 7 % 600 as endtime,
       case when host % 3 = 0 and seq % 10 = 9 then {_ip("10.2", "host")} else {_ip("10.1", "host")} end as srcaddr,
       concat('203.0.113.', cast(host % 200 as string)) as dstaddr,
       case when seq % 2 = 0 then 2 else 3 end as tcpflags,
       case when event_id % 97 = 0 then 'REJECT' else 'ACCEPT' end as action
from (select *, {NOW} - 120 * seq - 30 + case when host % 4 = 0 then 0 else (user_id * 97 + event_id * 31) % 600 end as starttime
      from (select *, event_id // 240 as host, event_id % 240 as seq from events) e) t
"""

# Configuration snapshots of EC2 instances, one row per interface. About a
# seventh are older than the look-back.
FLAT["config_snapshot"] = f"""
select o_custkey as n, o_orderkey as snapshot,
       case when o_orderkey % 50 = 0 then 'acct-9' else {_id("acct-", "o_custkey % 3")} end as account_id,
       {_id("i-", "o_custkey")} as instance_id,
       {NOW} - (o_orderkey * 7919) % 3000000 as recorded_at,
       case when o_custkey % 13 = 0 then null else {NOW} - (o_custkey * 104729) % 4000000 end as launched,
       o_orderkey % 5 = 0 as capitals
from orders
"""
FLAT["config_interface"] = f"""
select *, {_ip("10.20", "n")} as ip_address, {_id("eni-", "n")} as eni_id
from config_snapshot where n % 11 <> 0
union all
select *, {_id("10.21.0.", "n")} as ip_address, {_id("eni-b", "n")} as eni_id
from config_snapshot where n % 11 <> 0 and n % 4 = 0
"""

# Launch events: one instance also known to the configuration, one known only here.
FLAT["launch_event"] = f"""
select c_custkey as n, {_id("acct-", "c_custkey % 3")} as account_id,
       {NOW} - (c_custkey * 6151) % 3000000 as recorded_at
from customer
"""
FLAT["launch_item"] = f"""
select n, account_id, recorded_at, {_id("i-", "n")} as instance_id, {_ip("10.20", "n")} as ip_address,
       {_id("eni-", "n")} as eni_id, recorded_at - 5 as launched
from launch_event
union all
select n, account_id, recorded_at, {_id("i-x", "n")} as instance_id, {_ip("10.22", "n")} as ip_address,
       {_id("eni-x", "n")} as eni_id, recorded_at + 5 as launched
from launch_event
"""
FLAT["stop_event"] = f"""
select c_custkey as n, {_id("acct-", "c_custkey % 3")} as account_id,
       case c_custkey % 3 when 0 then 'StopInstances' when 1 then 'TerminateInstances' else 'StartInstances' end as event_name,
       {NOW} - (c_custkey * 3571) % 2800000 as event_time
from customer
union all
select s_suppkey as n, 'acct-7' as account_id, 'TerminateInstances' as event_name,
       {NOW} - (s_suppkey * 7127) % 500000 as event_time
from supplier
"""

# Interfaces of the configuration, and interface creations.
FLAT["config_eni"] = f"""
select p_partkey as n, {_id("acct-", "p_partkey % 3")} as account_id, {_id("eni-", "p_partkey")} as eni_id,
       {_ip("10.20", "p_partkey")} as private_ip, {NOW} - (p_partkey * 5003) % 3000000 as recorded_at,
       case when p_partkey % 7 = 0 then 'natGateway' else 'interface' end as interface_type,
       case p_partkey % 6 when 0 then 'ELB app/x' when 1 then 'AWS Lambda VPC ENI-fn' when 2 then '' when 3 then null
            else 'note' end as description,
       case p_partkey % 4 when 0 then null when 1 then 'ec2-1-2-3-4' else 'other' end as public_name,
       case p_partkey % 5 when 0 then 'eks-nodes' when 1 then null else 'web' end as group_name,
       case p_partkey % 8 when 0 then 'ip-10-0-0-1.ec2.internal' when 1 then 'ip.eu-west-1.compute.internal' else 'x' end as dns_name
from part
"""
FLAT["create_eni"] = f"""
select c_custkey as n, {_id("acct-", "c_custkey % 3")} as account_id, {_id("eni-", "c_custkey + 700")} as eni_id,
       {_ip("10.20", "c_custkey + 3")} as private_ip, {NOW} - (c_custkey * 4001) % 3000000 as event_time,
       case when c_custkey % 23 = 0 then 'Client.Failed' end as error_code,
       case c_custkey % 17 when 0 then 'elasticloadbalancing.amazonaws.com' when 1 then 'ecs.amazonaws.com'
            when 11 then 'apigateway.amazonaws.com' else '198.51.100.7' end as source_ip_address,
       case c_custkey % 17 when 2 then 'aws-K8S-node' when 13 then 'AWS Lambda VPC ENI-f' else 'made by hand' end as request_description,
       case c_custkey % 17 when 3 then 'elasticfilesystem.amazonaws.com' when 4 then 'eks.amazonaws.com'
            when 5 then 'rds.amazonaws.com' when 6 then 'clientvpn.amazonaws.com'
            when 7 then 'elasticmapreduce.amazonaws.com' when 8 then 'transitgateway.amazonaws.com'
            when 9 then 'redshift.amazonaws.com' when 10 then 'es.amazonaws.com' end as invoked_by,
       case c_custkey % 17 when 12 then 'AROA:AmazonSageMaker' else 'AIDA' end as principal_id,
       case c_custkey % 17 when 14 then {_id("i-", "c_custkey")} end as eni_instance_id
from customer
"""

# NICs and VMs of the inventory (several snapshots each, in two versions of
# tags), in creation events, and in deletion events.
FLAT["nic_snapshot"] = f"""
select o_custkey as n, o_orderkey % 2 as version, {NOW} - (o_orderkey * 7919) % 3000000 as seen_at
from orders
"""
FLAT["nic_created"] = f"""
select c_custkey as n, {NOW} - (c_custkey * 6151) % 3000000 as seen_at,
       case when c_custkey % 9 = 0 then 'Failed' else 'Succeeded.Created' end as signature
from customer
"""
FLAT["nic_deleted"] = f"""
select c_custkey as n, {NOW} - (c_custkey * 3571) % 2800000 as event_time,
       case when c_custkey % 4 = 0 then 'Success' else 'Start' end as result_type
from customer
union all
select s_suppkey * 3 as n, {NOW} - (s_suppkey * 7127) % 500000 as event_time, 'Success' as result_type
from supplier
"""

# Three tuples per lineitem under two rules: allowed begin and end, and one tuple denied when the
# flow was, else allowed. Every seventh record has an empty second rule.
FLAT["azure_tuple"] = f"""
select f.*, {_id("sub-", "l_suppkey % 3")} as subscription, 'begin' as kind, 'allow-web' as rule from flow f
union all
select f.*, {_id("sub-", "l_suppkey % 3")} as subscription, 'end' as kind, 'allow-web' as rule from flow f
union all
select f.*, {_id("sub-", "l_suppkey % 3")} as subscription, 'third' as kind, 'other' as rule from flow f
where l_orderkey % 7 <> 0
"""

# GCP: as the flows, but a miss (no bytes) ends when it starts. In the last hour four
# machines make all connections, and every other one is a miss.
FLAT["gcp_flow"] = f"""
select *, case when gcp_bytes = 0 then starttime else endtime end as gcp_end,
       case when late then {_id("vm-", "l_suppkey % 4")} else {_id("vm-", "l_suppkey")} end as own_vm,
       case when l_partkey % 4 = 0 then {_id("vm-", "(l_partkey % 5) * 2")} end as other_vm
from (select *, case when late and l_orderkey % 2 = 0 then 0 else bytes end as gcp_bytes
      from (select *, starttime >= {NOW - HOUR} as late from flow) l) f
"""
FLAT["gcp_created"] = f"""
select c_custkey as n, {NOW} - (c_custkey * 6151) % 3000000 as recorded_at,
       {NOW} - (c_custkey * 6151) % 3000000 - 100 + (c_custkey % 3) * 100 as start_time
from customer
"""
FLAT["gcp_snapshot"] = f"""
select o_custkey as n, o_orderkey % 3 as form, {NOW} - (o_orderkey * 7919) % 400000 as recorded_at,
       {NOW} - 5000000 + o_custkey * 17 as start_time
from orders
"""
FLAT["gcp_deleted"] = f"""
select c_custkey as n, {NOW} - (c_custkey * 3571) % 2800000 as recorded_at,
       case when c_custkey % 5 = 0 then 'delete' else 'stop' end as operation
from customer
"""

# Object lists for the tag map: the second element repeats the key of the first
# for a third of the rows, the third lacks a value.
FLAT["tag_list"] = """
select o_orderkey as n, case o_orderkey % 3 when 0 then 'k1' else 'k2' end as second_key,
       o_orderstatus as v1, o_orderpriority as v2
from orders
"""


def closure(text: str) -> list[str]:
    """Names of the flat entries a query text needs, in order."""
    needed: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\b(?:from|join)\s+(\w+)", pending.pop()))
        for name in words & FLAT.keys() - needed:
            needed.add(name)
            pending.append(FLAT[name])
    return [name for name in FLAT if name in needed]


def with_flat(text: str, extra: dict[str, str] | None = None) -> str:
    """The query with the flat entries it needs, and `extra` ones, as common table expressions."""
    extra = extra or {}
    everything = " ".join([text, *extra.values()])
    ctes = [f"{name} as ({FLAT[name]})" for name in closure(everything)]
    ctes += [f"{name} as ({sql})" for name, sql in extra.items()]
    return f"with {', '.join(ctes)} {text}" if ctes else text
