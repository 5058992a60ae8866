"""The same results in plain SQL over the flat rows: literal joins and windows, no rewrites."""

from __future__ import annotations

from workload.flat import DAY, HOUR, NOW, with_flat

_MONTH_AGO = NOW - 30 * DAY
_BASELINE = f"between {NOW - 25 * HOUR} and {NOW - HOUR}"

EXTRA: dict[str, str] = {}


def _minutes(a: str, b: str) -> str:
    return f"(({b}) // 60 - ({a}) // 60)"


# ---- AWS ----

_AWS_FLOW = """a.accountid, a.instanceid, a.interfaceid, a.srcaddr, a.srcport, a.dstaddr, a.dstport,
    a.protocol, a.packets, a.bytes, a.tcpflags, a.action"""


def _ec2(end: str, machine: str = "machine") -> str:
    return f"""
    select {_AWS_FLOW}, a.starttime, b.instance_id as src_instance_id, b.account_id as src_account_id,
           b.instance_role as src_role, c.instance_id as dst_instance_id, c.account_id as dst_account_id,
           c.instance_role as dst_role, a.srcaddr = b.ip_address as owner_is_src
    from flow a left join {machine} b on a.instanceid = b.instance_id
    left join {machine} c on c.instance_id <> a.instanceid and a.starttime >= c.window_start and {end}
         and (a.srcaddr = b.ip_address and a.dstaddr = c.ip_address or a.dstaddr = b.ip_address and a.srcaddr = c.ip_address)"""


EXTRA["ec2"] = _ec2("(a.starttime <= c.window_end or c.window_end is null)")
EXTRA["ec2_closed"] = _ec2("a.starttime <= c.window_end")

EXTRA["rst_baseline"] = f"""
    select avg(rate) as avg_rst_by_role, stddev(rate) as stddev_rst_by_role, instance_role
    from (select a.instance_role, total / role_count as rate
          from (select count(*) as total, b.instance_role, (f.recorded_at // {HOUR}) % 24 as hour_of_day
                from flow f left join machine b on f.instanceid = b.instance_id
                where f.recorded_at {_BASELINE} and f.tcpflags = 4 group by 2, 3) a
          join (select count(*) as role_count, instance_role from machine
                where latest_available_data {_BASELINE} group by 2) r on a.instance_role = r.instance_role) t
    group by 3"""

_STATS = """round(avg(gap), 6) as avg_prev_time_diff, round(stddev(gap), 6) as stddev_prev_time_diff,
    round(variance(gap), 6) as variance_prev_time_diff, round(avg(duration), 6) as avg_connection_duration,
    round(stddev(duration), 6) as stddev_connection_duration"""


def _beacons(columns: str, condition: str, thresholds: str) -> str:
    return f"""
    select * from (
        select count(*) as beacon_count, {_STATS}, {columns}
        from (select *, {_minutes("starttime", "later")} as gap
              from (select *, lag(starttime) over (partition by host, dstaddr
                            order by starttime desc, duration desc nulls last, srcaddr desc) as later
                    from (select *, {_minutes("starttime", "endtime")} as duration from beacon
                          where recorded_at >= {NOW - 4 * HOUR} and srcaddr like '10.%' and dstaddr not like '10.%'
                          {condition}) b) l) g
        where later is not null
        group by host, srcaddr, dstaddr) s
    where {thresholds}"""


_BEACONING = "beacon_count > 100 and variance_prev_time_diff < 0.3 and avg_prev_time_diff > 1"
_ALL_PAIRS = "beacon_count > 0 and variance_prev_time_diff < 1e12 and avg_prev_time_diff > -1"
_AWS_BEACON = ("host as instanceid, srcaddr, dstaddr", "and tcpflags in (2, 3) and action = 'ACCEPT'")
_GCP_BEACON = ("host as src_vm_name, srcaddr as src_ip, dstaddr as dst_ip", "")

_ROLE_N = "case n % 4 when 0 then 'apache' when 1 then 'jump_box' when 2 then 'db' end"
_TEAM_TAGS = f"""case when n % 4 = 3 then concat('{{"team":"t', cast(n % 5 as string), '"}}')
    else concat('{{"instance_role":"', {_ROLE_N}, '","team":"t', cast(n % 5 as string), '"}}') end"""



def _tag_list(key: str, value: str) -> str:
    return f"""concat('[', case when n % 4 <> 3 then concat('{{"{key}":"instance_role","{value}":"', {_ROLE_N}, '"}},') else '' end,
        '{{"{key}":"team","{value}":"old"}},{{"{key}":"team","{value}":"t', cast(n % 5 as string), '"}},{{"{key}":"orphan"}}]')"""


def _nic_list(*pairs: tuple[str, str]) -> str:
    return " || ',' || ".join(f"""concat('{{"privateIpAddress":"', {ip}, '","networkInterfaceId":"', {eni}, '"}}')""" for ip, eni in pairs)


_OWN_NIC = ("concat('10.20.', cast((n // 2) // 250 as string), '.', cast((n // 2) % 250 as string))", "concat('eni-', cast(n as string))")
_SECOND_NIC = ("concat('10.21.0.', cast(n as string))", "concat('eni-b', cast(n as string))")


def _described(tags: str, key: str, value: str, launch: str) -> str:
    """A recorded configuration as text; an unknown launch is left out."""
    nics = f"case when n % 4 = 0 then {_nic_list(_OWN_NIC, _SECOND_NIC)} else {_nic_list(_OWN_NIC)} end"
    at = "strftime(to_timestamp(launched) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ')"
    return f"""concat('{{"networkInterfaces":[', {nics}, '],"{tags}":', {_tag_list(key, value)},
        case when launched is null then '' else concat(',"{launch}":"', {at}, '"') end, '}}')"""


EXTRA["sighting"] = f"""
    select 'AWS_CONFIG' as flag, account_id, instance_id, ip_address, recorded_at, {_TEAM_TAGS} as tags, launched,
           case when capitals then {_described("Tags", "Key", "Value", "LaunchTime")}
                else {_described("tags", "key", "value", "launchTime")} end as details
    from config_interface where recorded_at >= {_MONTH_AGO}
    union all
    select 'CLOUDTRAIL' as flag, account_id, instance_id, ip_address, recorded_at, {_TEAM_TAGS} as tags, launched,
           concat('{{"instanceId":"', instance_id, '","launchTime":', cast(launched * 1000 as string),
                  ',"networkInterfaceSet":{{"items":[{{"networkInterfaceId":"', eni_id, '","privateIpAddress":"', ip_address,
                  '"}}]}},"privateIpAddress":"', ip_address, '","tagSet":{{"items":', {_tag_list("key", "value")}, '}}}}') as details
    from launch_item where recorded_at >= {_MONTH_AGO}"""
EXTRA["last_sighting"] = """
    select *, case when first_seen < launched then first_seen else launched end as launch_time
    from (select *, min(recorded_at) over one_instance as first_seen, max(recorded_at) over one_instance as last_seen
          from sighting window one_instance as (partition by account_id, instance_id)) s
    where recorded_at = last_seen"""
EXTRA["instance_ip"] = """
    select ip_address, instance_id, max(recorded_at) as recorded_at, max(launch_time) as launch_time, max(tags) as tags,
           max(flag) as flag, max(account_id) as account_id, arg_max(details, sha256(details)) as details
    from last_sighting group by ip_address, instance_id"""
EXTRA["stop_item"] = f"""
    select account_id, event_time, concat('i-', cast(n as string)) as instance_id from stop_event
    where event_name <> 'StartInstances' and event_time >= {_MONTH_AGO}
    union all
    select account_id, event_time, concat('i-x', cast(n as string)) as instance_id from stop_event
    where event_name <> 'StartInstances' and event_time >= {_MONTH_AGO}"""
EXTRA["ended"] = "select account_id, instance_id, max(event_time) as ended_at from stop_item group by 1, 2"

def _every_eni(owner: str) -> str:
    # What interfaces are taken for, by first match; the names, prefixes and types are the sources'.
    return f"""
    select c.recorded_at, c.account_id, c.eni_id, c.private_ip,
           case when interface_type = 'interface' and public_name is null and group_name like '%eks%' then 'kubernetes'
                when description like 'ELB %' then 'network_load_balancer'
                when interface_type = 'interface' and public_name like 'ec2-%' and group_name is not null then 'ec2'
                when dns_name like '%ec2.internal%' then 'ec2-instance'
                when dns_name like '%compute.internal%' then 'ec2-instance'
                when interface_type = 'interface' and description like 'AWS Lambda VPC ENI%' then 'lambda'
                else interface_type end as object_type,
           case when description <> '' then description
                when interface_type = 'interface' and public_name like 'ec2-%' and group_name is not null then 'ec2-instance'
                when m.instance_id is not null then 'ec2-instance' else 'unknown' end as object_name,
           coalesce(m.instance_id, 'config') as eni_instance_id, 'config' as source
    from config_eni c left join {owner} m on m.eni_id = c.eni_id
    union
    select event_time, account_id, eni_id, private_ip, kind,
           case when kind = 'network_load_balancer' then request_description else 'unknown' end,
           eni_instance_id, 'network_interface_cloudtrail'
    from (select *, case
              when source_ip_address = 'elasticloadbalancing.amazonaws.com' then 'network_load_balancer'
              when source_ip_address = 'ecs.amazonaws.com' then 'ecs'
              when request_description like 'aws-K8S-%' then 'eks'
              when invoked_by = 'elasticfilesystem.amazonaws.com' then 'efs'
              when invoked_by = 'eks.amazonaws.com' then 'eks'
              when invoked_by = 'rds.amazonaws.com' then 'rds'
              when invoked_by = 'clientvpn.amazonaws.com' then 'clientvpn'
              when invoked_by = 'elasticmapreduce.amazonaws.com' then 'emr'
              when invoked_by = 'transitgateway.amazonaws.com' then 'transitgateway'
              when invoked_by = 'redshift.amazonaws.com' then 'redshift'
              when invoked_by = 'es.amazonaws.com' then 'elasticsearch'
              when source_ip_address = 'apigateway.amazonaws.com' then 'apigateway'
              when principal_id like '%:AmazonSageMaker' then 'sagemaker'
              when request_description like 'AWS Lambda VPC ENI-%' then 'lambda'
              when eni_instance_id is null then 'ec2-instance' else 'unknown' end as kind
          from create_eni where error_code is null) k
    union
    select recorded_at - 60, account_id, eni_id, ip_address, 'ec2-instance', 'ec2-instance', instance_id,
           'run_instance_cloudtrail'
    from launch_item"""


def _grouped_eni(every: str) -> str:
    return f"""
    select eni_id, account_id, max(source) as source, max(eni_instance_id) as eni_instance_id, max(object_name) as object_name,
           min(object_type) as object_type, min(private_ip) as private_ip, max(recorded_at) as last_recorded,
           min(recorded_at) as window_start
    from {every} group by all"""


EXTRA["every_eni"] = _every_eni("machine")
EXTRA["grouped_eni"] = _grouped_eni("every_eni")

# ---- Azure ----

_NIC_PATH = """lower(concat('/subscriptions/sub-', cast({n} % 3 as string),
    '/resourceGroups/RG/providers/Microsoft.Network/networkInterfaces/NIC-', cast({n} as string)))"""
_VM_PATH = """lower(concat('/subscriptions/sub-', cast(n % 3 as string),
    '/resourceGroups/RG/providers/Microsoft.Compute/virtualMachines/VM-', cast(n as string)))"""

EXTRA["nic_version"] = f"""
    select n, 'collect_script' as source, min(seen_at) as earliest,
           case when n % 6 = 1 and version = 0 then null else concat('{{"v":"', cast(version as string), '"}}') end as tags
    from nic_snapshot where seen_at >= {_MONTH_AGO} group by n, version
    union
    select n, 'operation_logs', min(seen_at), '{{"v":"2"}}'
    from nic_created where seen_at >= {_MONTH_AGO} and signature = 'Succeeded.Created' group by n"""
EXTRA["nic_first"] = "select n, min(earliest) as window_start from nic_version group by n"
EXTRA["nic_ip"] = """
    select v.*, window_start, 1 as is_primary,
           concat('10.0.', cast((v.n // 2) // 250 as string), '.', cast((v.n // 2) % 250 as string)) as private_ip
    from nic_version v join nic_first f on v.n = f.n where v.n % 19 <> 0
    union all
    select v.*, window_start, 0 as is_primary, concat('10.9.9.', cast(v.n as string)) as private_ip
    from nic_version v join nic_first f on v.n = f.n where v.n % 19 <> 0 and v.n % 5 = 0"""


def _one_ip(name: str, primary: str, address: str) -> str:
    return f"""concat('{{"name":"{name}","properties":{{"primary":{primary},"privateIPAddress":"', {address}, '"}}}}')"""


_FIRST_IP = _one_ip("first", "true", "concat('10.0.', cast((n // 2) // 250 as string), '.', cast((n // 2) % 250 as string))")
_SECOND_IP = _one_ip("second", "false", "concat('10.9.9.', cast(n as string))")
_NIC_TEXT = f"""concat('{{"ipConfigurations":[', case when n % 19 = 0 then '' when n % 5 = 0 then concat({_SECOND_IP}, ',', {_FIRST_IP})
    else {_FIRST_IP} end, ']}}')"""


def _nics(keys: str) -> str:
    return f"""
    select t.*, coalesce(d.event_time, next_start) as window_end
    from (select *, case when private_ip is not null then
              lead(window_start) over (partition by private_ip order by earliest, nic_id) end as next_start
          from (select *, {_NIC_PATH.format(n="n")} as nic_id,
                       row_number() over (partition by {keys} order by tags desc nulls first, is_primary desc,
                                          source desc, earliest desc) as rn
                from nic_ip) r where rn = 1) t
    left join nic_deleted d on d.n = t.n and d.result_type = 'Success' and d.event_time >= {_MONTH_AGO}"""


EXTRA["nic"] = _nics("n")
EXTRA["nic_every_ip"] = _nics("n, private_ip")
_NIC_OUT = """select 'tenant-1' as tenant_id, concat('sub-', cast(n % 3 as string)) as subscription_id, nic_id,
    concat('nic-', cast(n as string)) as nic_name, 'westeurope' as nic_location, tags as nic_tags, source, private_ip,
    earliest, window_start, window_end, sha256({nic_text}) as nic_properties_sha256,
    case is_primary when 1 then {first_ip} else {second_ip} end as ip_configuration from """.format(
    nic_text=_NIC_TEXT, first_ip=_FIRST_IP, second_ip=_SECOND_IP
)



_NIC_REF = _NIC_PATH.format(n="n").replace("lower(", "(").replace("nic-", "NIC-")
_VM_TEXT = f"""concat('{{"networkProfile":{{"networkInterfaces":[{{"id":"', {_NIC_REF}, '"}}',
    case when n % 10 = 0 then concat(',{{"id":"', upper({_NIC_REF}), '0"}}') else '' end,
    ']}},"osProfile":{{"computerName":"host-', cast(n as string), '"}}}}')"""


def _vm_tags(version: str) -> str:
    return f"""case when n % 4 = 3 then null
    else concat('{{"instance_role":"', {_ROLE_N}, '","v":"', {version}, '"}}') end"""


EXTRA["vm_version"] = f"""
    select n, {_vm_tags("cast(version as string)")} as tags, 'WestEurope' as location,
           concat('sub-', cast(n % 3 as string)) as subscription_id, min(seen_at) as earliest, max(seen_at) as latest
    from nic_snapshot where seen_at >= {_MONTH_AGO} group by 1, 2, 3, 4
    union
    select n, {_vm_tags("'2'")}, 'WESTEUROPE', concat('SUB-', cast(n % 3 as string)),
           min(seen_at), max(seen_at)
    from nic_created where seen_at >= {_MONTH_AGO} and signature <> 'Failed' group by 1, 2, 3, 4"""
EXTRA["vm"] = f"""
    select distinct window_start, coalesce(d.event_time, latest) as window_end, v.n, v.tags, v.location, v.subscription_id,
           {_VM_PATH.replace("n %", "v.n %").replace("cast(n ", "cast(v.n ")} as vm_id
    from vm_version v join (select n, min(earliest) as window_start from vm_version group by n) f on f.n = v.n
    left join nic_deleted d on d.n = v.n and d.result_type = 'Success' and d.event_time >= {_MONTH_AGO}"""
EXTRA["vm_nic"] = """
    select v.window_start as vm_window_start, v.window_end as vm_window_end, v.vm_id, v.tags as vm_tags, v.n as vm_n,
           m.nic_id, m.n as nic_n, m.tags as nic_tags, m.private_ip, m.window_start, m.window_end
    from vm v join nic m on m.n = v.n or (v.n % 10 = 0 and v.n > 0 and m.n = v.n * 10)"""

EXTRA["azure_flow"] = """
    select recorded_at, recorded_at as time_stamp, case kind when 'end' then endtime else starttime end as event_time,
           '000D3AF87856' as mac_address,
           concat('/SUBSCRIPTIONS/SUB-', cast(l_suppkey % 3 as string), '/RESOURCEGROUPS/RG') as resource_id, subscription,
           case kind when 'third' then '000D3AF87857' else '000D3AF87856' end as flow_mac, rule,
           srcaddr as src_addr, dstaddr as dst_addr, srcport as src_port, dstport as dst_port,
           case protocol when 6 then 'TCP' when 17 then 'UDP' end as protocol,
           case when l_linenumber % 3 = 0 then 'INBOUND' else 'OUTBOUND' end as traffic_flow,
           case when kind = 'third' and action = 'REJECT' then 'DENIED' else 'ALLOWED' end as traffic_decision,
           case kind when 'begin' then 'BEGIN' when 'end' then 'END' else 'CONTINUING' end as flow_state,
           case kind when 'end' then packets end as packets_src_to_dst, case kind when 'end' then bytes end as bytes_src_to_dst,
           case kind when 'end' then packets + 1 end as packets_dst_to_src, case kind when 'end' then bytes + 1 end as bytes_dst_to_src
    from azure_tuple"""
_AZURE_FLOW = """mac_address, resource_id, rule, src_addr, dst_addr, src_port, dst_port, protocol, traffic_flow,
    traffic_decision, flow_state, packets_src_to_dst, bytes_src_to_dst, packets_dst_to_src, bytes_dst_to_src"""
EXTRA["azure_joined"] = f"""
    select distinct a.recorded_at as flow_recorded_at, a.time_stamp, a.event_time, {_AZURE_FLOW},
           b.nic_id as src_nic_id, b.private_ip as src_ip_addr, b.vm_id as src_vm_id, b.vm_tags as src_vm_tags,
           b.nic_tags as src_nic_tags, c.nic_id as dst_nic_id, c.private_ip as dst_ip_addr, c.vm_id as dst_vm_id,
           c.vm_tags as dst_vm_tags, c.nic_tags as dst_nic_tags
    from azure_flow a
    left join vm_nic b on a.src_addr = b.private_ip and a.event_time >= b.window_start
         and (a.event_time <= b.window_end or b.window_end is null)
         and a.subscription = concat('sub-', cast(b.nic_n % 3 as string))
    left join vm_nic c on a.dst_addr = c.private_ip and a.event_time >= c.window_start
         and (a.event_time <= c.window_end or c.window_end is null)"""
_ENRICHED = f"""flow_recorded_at, event_time, {_AZURE_FLOW}, src_nic_id, src_ip_addr, src_vm_id, src_vm_tags,
    dst_nic_id, dst_ip_addr, dst_vm_id, dst_vm_tags"""


def _json_role(tags: str) -> str:
    return f"json_extract_string({tags}, '$.instance_role')"


EXTRA["denied_baseline"] = f"""
    select avg(denied / role_count) as avg_denied_count, stddev(denied / role_count) as stddev_denied_count, src_role
    from (select count(*) as denied, {_json_role("src_vm_tags")} as src_role, flow_recorded_at // {HOUR} as hour
          from azure_joined where flow_recorded_at {_BASELINE} and traffic_decision = 'DENIED' group by 2, 3) c
    left join (select count(*) as role_count, {_json_role("tags")} as role from vm
               where window_end {_BASELINE} group by 2) r on r.role = c.src_role
    group by 3"""

# ---- GCP ----

EXTRA["gcp_sighting"] = f"""
    select n, concat('p', cast(n % 2 as string)) as project, recorded_at, start_time, 'create' as source,
           case when n % 8 = 7 then null else {_TEAM_TAGS} end as tags, cast(null as varchar) as nics
    from gcp_created where recorded_at >= {_MONTH_AGO}
    union all
    select n, case when n % 10 = 0 and form = 2 then 'other' else concat('p', cast(n % 2 as string)) end as project,
           recorded_at, start_time, 'snapshot' as source, case when n % 4 = 3 then null else {_TEAM_TAGS} end as tags,
           concat('[{{"networkIP":"10.40.0.', cast(n as string), '"}}]') as nics
    from gcp_snapshot where recorded_at >= {NOW - 3 * DAY}"""
EXTRA["gcp_group"] = """
    select n, project, source, tags, nics, start_time,
           min(case when source = 'create' then least(recorded_at, start_time) else recorded_at end) as earliest,
           max(recorded_at) as latest
    from gcp_sighting group by 1, 2, 3, 4, 5, 6"""
EXTRA["gcp_bounds"] = """
    select n, project, max(latest) as true_latest, min(least(earliest, start_time)) as true_earliest
    from gcp_group group by 1, 2"""
EXTRA["gcp_helper"] = """
    select min(g.start_time) as start_time, true_earliest, true_latest, g.n, g.project, min(g.tags) as tags, g.nics
    from gcp_group g join gcp_bounds b on b.n = g.n and b.project = g.project and g.latest = b.true_latest
    group by true_earliest, true_latest, g.n, g.project, g.nics"""
EXTRA["gcp_vm"] = f"""
    select a.*, concat('vm-', cast(a.n as string)) as vm_name,
           concat('projects/', a.project, '/zones/z1/instances/vm-', cast(a.n as string)) as resource_name,
           least(a.start_time, a.true_earliest) as earliest,
           greatest(a.true_latest, coalesce(t.recorded_at, a.true_latest)) as last_seen, t.recorded_at as term_time
    from (select min(start_time) as start_time, true_earliest, true_latest, n, project, tags, max(nics) as nics
          from gcp_helper group by true_earliest, true_latest, n, project, tags) a
    left join gcp_deleted t on t.operation = 'delete' and t.recorded_at >= {_MONTH_AGO} and t.n = a.n
         and a.project = concat('p', cast(t.n % 2 as string))"""
EXTRA["gcp_named"] = """
    select *, case when l_linenumber % 3 = 0 then other_vm else own_vm end as src_vm_name,
           case when l_linenumber % 3 = 0 then own_vm else other_vm end as dst_vm_name
    from gcp_flow"""
EXTRA["gcp_joined"] = f"""
    select a.recorded_at, a.starttime as start_time, a.gcp_end as end_time, a.srcaddr as src_ip, a.srcport as src_port,
           a.dstaddr as dst_ip, a.dstport as dst_port, a.protocol, a.gcp_bytes as bytes, a.src_vm_name, a.dst_vm_name,
           b.tags as src_tags, b.nics as src_nics, c.tags as dst_tags, c.nics as dst_nics
    from gcp_named a left join gcp_vm b on a.src_vm_name = b.vm_name left join gcp_vm c on a.dst_vm_name = c.vm_name
    where a.recorded_at >= {NOW - 25 * HOUR}"""
_MISS = f"""select count(*) as miss_count, {{columns}}, {_json_role("dst_tags")} as dst_role,
    {_json_role("src_tags")} as src_role from gcp_joined
    where recorded_at {{when}} and start_time = end_time and bytes = 0 group by all"""
EXTRA["gcp_baseline"] = f"""
    select avg(miss_count) as avg_miss_count, stddev(miss_count) as stddev_miss_count, src_role, dst_role
    from ({_MISS.format(columns=f"(recorded_at // {HOUR}) % 24 as hour_of_day", when=_BASELINE)}) m
    join (select count(*) as instances, {_json_role("tags")} as role from gcp_vm
          where last_seen {_BASELINE} group by 2) r on r.role = m.src_role
    group by 3, 4"""


def _needed(text: str) -> dict[str, str]:
    """The extra expressions a query needs, in order."""
    import re

    found: set[str] = set()
    pending = [text]
    while pending:
        for name in set(re.findall(r"\b(?:from|join)\s+(\w+)", pending.pop())) & EXTRA.keys() - found:
            found.add(name)
            pending.append(EXTRA[name])
    return {name: sql for name, sql in EXTRA.items() if name in found}


EXTRA["entity"] = """
            select a.instance_id, a.account_id, ip_address, flag, tags, sha256(details) as details_sha256, recorded_at,
                   recorded_at as latest_available_data, launch_time, launch_time as window_start,
                   coalesce(b.ended_at, case when ip_address is not null and launch_time is not null then
                            lead(launch_time) over (partition by ip_address
                            order by launch_time asc nulls last, a.instance_id) end) as window_end
            from instance_ip a left join ended b on a.instance_id = b.instance_id
                 and a.recorded_at // 86400 <= b.ended_at // 86400"""
# Machines as the operators derive them, in the shape of the flat ones.
EXTRA["derived"] = """
    select instance_id, account_id, nullif(regexp_extract(tags, '"instance_role":"([^"]*)"', 1), '') as instance_role, ip_address, window_start, window_end,
           latest_available_data from entity"""
EXTRA["lister"] = """
    select eni_id, max(instance_id) as instance_id
    from (select instance_id, unnest(json_extract_string(details, '$.networkInterfaces[*].networkInterfaceId')) as eni_id
          from instance_ip) l
    group by eni_id"""
EXTRA["derived_eni"] = _every_eni("lister")
EXTRA["grouped_derived_eni"] = _grouped_eni("derived_eni")
EXTRA["derived_ec2"] = _ec2("(a.starttime <= c.window_end or c.window_end is null)", "derived")


def _query(text: str) -> str:
    return with_flat(text, _needed(text))


def _enis(grouped: str) -> str:
    return f"""
    select eni_id, account_id, private_ip, object_type, object_name, eni_instance_id, source, window_start,
           last_recorded, case when private_ip is not null and window_start is not null then
               lead(window_start) over (partition by private_ip
                               order by window_start asc nulls last, eni_id, account_id) end as window_end
    from {grouped}"""


def _listed(joined: str) -> str:
    return f"""
    select a.*, ioc_value from {joined} a join ioc on
        (srcaddr = ioc_value and action = 'ACCEPT' and not (dst_role = 'apache' and dstport = 443))
        or dstaddr = ioc_value
    where tcpflags in (2, 3)"""


def _unusual(joined: str) -> str:
    return f"""
    select * from {joined} where tcpflags in (2, 3) and (
        src_role = 'apache' or (src_role = 'jump_box' and dstport <> 22)
        or (dst_role = 'apache' and action = 'ACCEPT' and dstport <> 443 and srcaddr not like '10.%')
        or (srcaddr like '10.%' and (src_role is null or src_role not in ('apache', 'jump_box'))))"""


# When the records of each source of `admitted_records` were recorded, and whether they have the text that some lose.
_RECORDS = {
    "aws_config": "select recorded_at, true as has from config_snapshot union all select recorded_at, false from config_eni",
    "cloudtrail": """select recorded_at, true as has from launch_event union all select event_time, true from stop_event
        union all select event_time, true from create_eni""",
    "azure_collect_network_interfaces": "select seen_at as recorded_at, true as has from nic_snapshot",
    "azure_flow_logs_raw": "select recorded_at, true as has from flow",
    "gcp_cloud_assets": "select recorded_at, true as has from gcp_snapshot",
}


def oracle() -> dict[str, str]:
    texts = {
        "aws_instances": EXTRA["entity"],
        "aws_instances_by_day": EXTRA["entity"],
        "aws_enis": _enis("grouped_eni"),
        "aws_enis_chained": _enis("grouped_derived_eni"),
        "aws_flow_logs": f"select {_AWS_FLOW}, recorded_at, starttime, endtime from flow a",
        "aws_flow_logs_join_ec2": "select * from ec2",
        "aws_flow_logs_join_ec2_chained": "select * from derived_ec2",
        "aws_flow_logs_join_ec2_closed": "select * from ec2_closed",
        "aws_flow_logs_join_enis": f"""
            select {_AWS_FLOW}, a.starttime, b.eni_id, b.ip_address as eni_private_ip, b.account_id as eni_account_id,
                   c.eni_id as peer_eni_id, c.ip_address as peer_eni_private_ip, c.account_id as peer_eni_account_id
            from flow a left join machine b on a.interfaceid = b.eni_id
            left join machine c on c.eni_id <> a.interfaceid and a.starttime >= c.window_start
                 and (a.starttime <= c.window_end or c.window_end is null)
                 and ((a.srcaddr = b.ip_address and a.dstaddr = c.ip_address)
                      or (a.dstaddr = b.ip_address and a.srcaddr = c.ip_address))""",
        "aws_beaconing": _beacons(*_AWS_BEACON, _BEACONING),
        "aws_beaconing_all_pairs": _beacons(*_AWS_BEACON, _ALL_PAIRS),
        "aws_beaconing_by_hour": _beacons(*_AWS_BEACON, _ALL_PAIRS),
        "aws_ioc_connections": _listed("ec2"),
        "aws_ioc_connections_chained": _listed("derived_ec2"),
        "aws_rst_baseline": """
            select round(avg_rst_by_role, 6) as avg_rst_by_role, round(stddev_rst_by_role, 6) as stddev_rst_by_role,
                   instance_role from rst_baseline""",
        "aws_port_scanning": f"""
            select rst_last_hour, instanceid, a.instance_role, round(avg_rst_by_role, 6) as avg_rst_by_role,
                   round(stddev_rst_by_role, 6) as stddev_rst_by_role
            from (select count(*) as rst_last_hour, f.instanceid, b.instance_role
                  from flow f left join machine b on f.instanceid = b.instance_id
                  where f.recorded_at >= {NOW - HOUR} and f.tcpflags = 4 group by 2, 3) a
            join rst_baseline r on a.instance_role = r.instance_role
            where rst_last_hour >= avg_rst_by_role + stddev_rst_by_role""",
        "aws_unusual_role_ports": _unusual("ec2"),
        "aws_unusual_role_ports_chained": _unusual("derived_ec2"),
        "azure_nics": _NIC_OUT + "nic",
        "azure_nics_all_ips": _NIC_OUT + "nic_every_ip",
        "azure_vms": f"""
            select window_start, window_end, 'Tenant-1' as tenant_id, subscription_id, vm_id,
                   concat('host-', cast(n as string)) as vm_name, location, tags, sha256({_VM_TEXT}) as properties_sha256 from vm""",
        "azure_vms_nics": """
            select vm_id, concat('host-', cast(vm_n as string)) as vm_name, nic_id as vm_nic_id, vm_tags, private_ip,
                   vm_window_start, vm_window_end, window_start, window_end from vm_nic""",
        "azure_flow_logs": f"""
            select recorded_at, time_stamp, event_time, 'NetworkSecurityGroupFlowEvent' as category,
                   'NetworkSecurityGroupFlowEvents' as operation_name, 'sys-1' as system_id, flow_mac, {_AZURE_FLOW}
            from azure_flow""",
        "azure_flow_logs_join_vm_nics": f"select {_ENRICHED} from azure_joined",
        "azure_ioc_connections": f"""
            select {_ENRICHED}, ioc_value from azure_joined join ioc
            on (src_addr = ioc_value and traffic_decision = 'ALLOWED') or dst_addr = ioc_value""",
        "azure_denied_baseline": """
            select round(avg_denied_count, 6) as avg_denied_count, round(stddev_denied_count, 6) as stddev_denied_count,
                   src_role from denied_baseline""",
        "azure_port_scanning": f"""
            select src_vm_id, role_denied_count, a.src_role
            from (select count(*) as role_denied_count, src_vm_id, {_json_role("src_vm_tags")} as src_role,
                         flow_recorded_at // {HOUR} as hour
                  from azure_joined where flow_recorded_at >= {NOW - HOUR} and traffic_decision = 'DENIED'
                  group by 2, 3, 4) a
            join denied_baseline b on a.src_role = b.src_role
            where role_denied_count > avg_denied_count + stddev_denied_count""",
        "gcp_vms": """
            select 'acct' as account, vm_name, project as project_name, 'z1' as zone, resource_name, tags, nics,
                   earliest, last_seen, term_time from gcp_vm""",
        "gcp_flow_logs": f"""
            select recorded_at, endtime as event_time, starttime as start_time, gcp_end as end_time,
                   concat('log-', cast(l_orderkey as string)) as log_id, 'prod' as deployment, 'acct' as account,
                   concat('x', cast(l_partkey as string)) as insert_id, dstaddr as dst_ip, dstport as dst_port,
                   srcaddr as src_ip, srcport as src_port, protocol, gcp_bytes as bytes, packets, 'p0' as dst_project,
                   'r1' as dst_region, dst_vm_name, 'z1' as dst_zone, 'sn-b' as dst_subnet_name, 'p0' as src_project,
                   'r1' as src_region, src_vm_name, 'z1' as src_zone, 'sn-a' as src_subnet_name,
                   case when l_linenumber % 3 = 0 then 'DEST' else 'SRC' end as reporter
            from gcp_named where recorded_at >= {NOW - HOUR}""",
        "gcp_flow_logs_join_vms": "select * from gcp_joined",
        "gcp_beaconing": _beacons(*_GCP_BEACON, _BEACONING),
        "gcp_beaconing_all_pairs": _beacons(*_GCP_BEACON, _ALL_PAIRS),
        "gcp_ioc_connections": """
            select a.*, ioc_value from gcp_joined a join ioc on src_ip = ioc_value or dst_ip = ioc_value""",
        "gcp_connect_baseline": """
            select round(avg_miss_count, 6) as avg_miss_count, round(stddev_miss_count, 6) as stddev_miss_count,
                   src_role, dst_role from gcp_baseline""",
        "gcp_port_scanning": f"""
            select miss_count, src_vm_name, a.dst_role, a.src_role, round(avg_miss_count, 6) as avg_miss_count,
                   round(stddev_miss_count, 6) as stddev_miss_count
            from ({_MISS.format(columns="src_vm_name", when=f">= {NOW - HOUR}")}) a
            join gcp_baseline b on a.dst_role = b.dst_role and a.src_role = b.src_role
            where miss_count > avg_miss_count + stddev_miss_count""",
        "universal_flow_log": f"""
            select recorded_at, starttime as event_time, srcaddr as src_addr, srcport as src_port, dstaddr as dst_addr,
                   dstport as dst_port, case protocol when 6 then 'TCP' else 'UDP' end as protocol
            from flow where protocol in (6, 17)
            union all
            select recorded_at, starttime, srcaddr, srcport, dstaddr, dstport,
                   case protocol when 6 then 'TCP' else 'UDP' end
            from gcp_flow where protocol in (6, 17) and recorded_at >= {NOW - 25 * HOUR}
            union all
            select recorded_at, event_time, src_addr, src_port, dst_addr, dst_port, protocol from azure_flow""",
        "admitted_records": " union all ".join(
            f"""select '{name}' as source, count(*) as records, count(*) filter (where recorded_at % 97 <> 0 or not has) as admitted,
                count(*) filter (where recorded_at % 97 = 0 and has) as quarantined from ({rows}) r"""
            for name, rows in _RECORDS.items()
        ),
        "tags_to_map": """
            select n, case when second_key = 'k1' then concat('{"k1":"', v2, '"}')
                      else concat('{"k1":"', v1, '","k2":"', v2, '"}') end as tags
            from tag_list""",
        "canonical_json": "select event_id, replace(props, ' ', '') as props from events",
    }
    repeats = {
        "aws_rst_baseline_rolling": "aws_rst_baseline",
        "azure_nics_by_day": "azure_nics",
        "azure_denied_baseline_rolling": "azure_denied_baseline",
        "gcp_vms_by_day": "gcp_vms",
        "gcp_beaconing_by_hour": "gcp_beaconing_all_pairs",
        "gcp_connect_baseline_rolling": "gcp_connect_baseline",
    }
    texts |= {name: texts[other] for name, other in repeats.items()}
    return {name: _query(text) for name, text in texts.items()}
