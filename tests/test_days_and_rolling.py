"""Entities merged day by day, baselines that roll, and tables that say something about themselves."""

from datetime import date, datetime, timedelta, timezone

import pytest
import workload.queries
from conftest import NOW, as_set, optimized, plan_of
from pyspark.sql import functions as F

from flowspark import operators as op
from flowspark.functions import is_distinct
from flowspark.functions.times import PARTITION_DAY
from flowspark.operators.moments import combined, deviation, mean, moments_of
from flowspark.plans import ENTITY_VIEWS, EntityDays, RollingBaseline
from flowspark.sources import admit, cut_lineage, materialize, read_source, replace_partitions
from workload import inputs

SMALL = "/root/testdata/sf0.001"
SOURCES = ["aws_config", "cloudtrail", "azure_logs", "azure_collect_network_interfaces", "azure_collect_virtual_machines",
           "gcp_audit_logs", "gcp_cloud_assets"]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The sources of entities as written tables; those of AWS are cut by day."""
    folder = tmp_path_factory.mktemp("sources")
    written = {}
    for name in SOURCES:
        df = getattr(inputs, name)(spark, SMALL)
        dated = "recorded_at" if name in ("aws_config", "cloudtrail") else None
        written[name] = materialize(df, path=str(folder / name), date_column=dated)
    return written


def directly(sources, name, now):
    s = sources
    if name == "aws_instances":
        return op.aws_instances(s["aws_config"], s["cloudtrail"], now)
    if name == "aws_enis":
        return op.aws_enis(s["aws_config"], s["cloudtrail"], directly(s, "aws_instances", now))
    if name == "azure_nics":
        return op.azure_nics(s["azure_logs"], s["azure_collect_network_interfaces"], now)
    if name == "azure_vms":
        return op.azure_vms(s["azure_logs"], s["azure_collect_virtual_machines"], now)
    if name == "azure_vms_nics":
        return op.azure_vms_nics(directly(s, "azure_vms", now), directly(s, "azure_nics", now))
    return op.gcp_vms(s["gcp_audit_logs"], s["gcp_cloud_assets"], now)


@pytest.fixture(scope="module")
def days(spark, sources, tmp_path_factory):
    kept = EntityDays(spark, str(tmp_path_factory.mktemp("days")), sources)
    kept.merge()
    return kept


@pytest.mark.parametrize("name", list(ENTITY_VIEWS))
@pytest.mark.parametrize("now", [NOW, NOW - timedelta(days=3, hours=7, minutes=13)])
def test_views_from_days_equal_the_operators(sources, days, name, now):
    """Also where the look-back begins within a day."""
    mine = as_set(days.view(name, now))
    assert mine == as_set(directly(sources, name, now)) and mine


def test_days_merged_one_by_one_late_and_twice(spark, sources, tmp_path):
    """31 days in any order, one first without its configurations, others merged twice."""
    some = {"aws_config": sources["aws_config"], "cloudtrail": sources["cloudtrail"]}
    late = date(2024, 1, 30)
    number = (late - date(1970, 1, 1)).days
    early = {**some, "aws_config": some["aws_config"].where(F.col(PARTITION_DAY) != number)}
    path = str(tmp_path / "days")
    span = [date(2024, 1, 1) + timedelta(days=n) for n in range(31)]
    for chunk in (span[20:], span[:10], span[10:20], span[5:7]):
        EntityDays(spark, path, early).merge(*chunk)
    days = EntityDays(spark, path, some)
    whole = as_set(directly(sources, "aws_instances", NOW))
    assert as_set(days.view("aws_instances", NOW)) != whole
    days.merge(late)
    assert as_set(days.view("aws_instances", NOW)) == whole
    days.merge(late, date(2024, 1, 3))
    assert as_set(days.view("aws_instances", NOW)) == whole


def test_a_view_reads_kept_days_and_one_day_of_the_sources(days):
    """At midnight the sources aren't read at all; else only the day on which the look-back begins."""
    files = days.view("aws_instances", NOW).inputFiles()
    assert files and all("aws_instance_" in f for f in files)
    later = plan_of(days.view("aws_instances", NOW + timedelta(hours=5)))
    scans = [line for line in later.split("\n") if "FileScan" in line and "aws_instance_" not in line]
    day = (date(2024, 1, 1) - date(1970, 1, 1)).days
    assert len(scans) == 4 and all(f"= {day})" in line.split("PartitionFilters: ")[1] for line in scans)


def test_only_views_whose_sources_are_there(spark, sources, tmp_path):
    assert list(EntityDays(spark, str(tmp_path), {"gcp_audit_logs": sources["gcp_audit_logs"], "gcp_cloud_assets": sources["gcp_cloud_assets"]})) == ["gcp_vms"]


def test_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(spark.range(6).selectExpr("id", "id % 3 as k"), path, ["k"])
    replace_partitions(spark.range(2).selectExpr("id + 100 as id", "0L as k"), path, ["k"], [{"k": 0}, {"k": 1}, {"k": 9}])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(2, 2), (5, 2), (100, 0), (101, 0)]


# ---- baselines that roll ----


def resets(spark, hours, until, role="r"):
    """Flows with `hours[h]` resets in the hour that ends h hours before `until`, some of them at its very start."""
    rows = [(until - timedelta(hours=h) + timedelta(minutes=7 * n), role) for h, many in hours.items() for n in range(many)]
    return spark.createDataFrame(rows, "recorded_at timestamp, role string")


def by_role(flows):
    hour = F.date_trunc("hour", "recorded_at").alias("hour")
    return flows.groupBy("role", hour).agg(F.count("*").alias("n"))


def plainly(flows, now, by_hour_of_day):
    """Moments over all flows of the day before the last hour."""
    day = flows.where(F.col("recorded_at").between(F.lit(now - timedelta(hours=25)), F.lit(now - timedelta(hours=1))))
    hour = F.hour("recorded_at") if by_hour_of_day else F.date_trunc("hour", "recorded_at")
    return moments_of(day.groupBy("role", hour.alias("h")).agg(F.count("*").alias("n")), ["role"])


@pytest.mark.parametrize("by_hour_of_day", [True, False])
def test_rolling_equals_the_whole_baseline(spark, tmp_path, by_hour_of_day):
    flows = resets(spark, {h: (h * 5) % 4 for h in range(1, 40)}, NOW).unionByName(resets(spark, {3: 2, 27: 1}, NOW, "rare"))
    baseline = RollingBaseline(spark, str(tmp_path / "b"), ["role"], by_role, by_hour_of_day=by_hour_of_day)
    first = NOW - timedelta(hours=6)
    baseline.start(flows, first)
    for hours in range(6, -1, -1):
        now = NOW - timedelta(hours=hours)
        if hours < 6:
            # Of all flows, those of one hour and the instant after it are enough.
            only = flows.where(F.col("recorded_at").between(F.lit(now - timedelta(hours=2)), F.lit(now - timedelta(hours=1))))
            baseline.advance(only, now)
            if hours == 3:
                baseline.advance(only, now)
        assert as_set(baseline.moments(now)) == as_set(plainly(flows, now, by_hour_of_day)), hours


def test_a_baseline_rolls_at_full_hours_only(spark, tmp_path):
    with pytest.raises(ValueError):
        RollingBaseline(spark, str(tmp_path / "b"), ["role"], by_role).start(resets(spark, {1: 1}, NOW), NOW + timedelta(minutes=1))


def test_moments_add_up_and_come_apart(spark):
    counts = spark.createDataFrame([("a", n) for n in (1, 5, 9, 4)] + [("b", 3)], "k string, n bigint")
    first, second = counts.where("n < 5"), counts.where("n >= 5")
    whole = as_set(moments_of(counts, ["k"]))
    both = combined(["k"], (1, moments_of(first, ["k"])), (1, moments_of(second, ["k"])))
    assert as_set(both) == whole
    assert as_set(combined(["k"], (1, both), (-1, moments_of(second, ["k"])))) == as_set(moments_of(first, ["k"]))
    got = {r.k: (r.m, r.d) for r in both.select("k", mean().alias("m"), deviation(F.lit(2)).alias("d")).collect()}
    plain = counts.where("k = 'a'").agg(F.avg("n"), F.stddev("n") / 2).first()
    assert got["a"] == (pytest.approx(plain[0]), pytest.approx(plain[1])) and got["b"] == (3.0, None)


# ---- tables ----


def rows_read(df) -> int:
    """Rows that the scans of a query gave, from the metrics of its plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_one_address_skips_files(spark, tmp_path):
    """Clustered by address, with Bloom filters: a look for one address over all days reads under a tenth of the rows."""
    flows = spark.range(60_000).select(
        F.concat(F.lit("10.0."), F.xxhash64("id") % 3000).alias("srcaddr"),
        F.timestamp_seconds(1706140800 + (F.col("id") * 7919) % (3 * 86400)).alias("recorded_at"),
        "id",
    )
    one = flows.first().srcaddr
    clustered = materialize(flows, path=str(tmp_path / "c"), date_column="recorded_at", cluster_by="srcaddr", clusters=32, bloom=["srcaddr"])
    plain = materialize(flows, path=str(tmp_path / "p"), date_column="recorded_at")
    assert sorted(clustered.columns) == sorted(plain.columns)
    here, there = (df.where(F.col("srcaddr") == one) for df in (clustered, plain))
    assert as_set(here.select("id")) == as_set(there.select("id")) and here.count() > 1
    assert rows_read(clustered.where(F.col("srcaddr") == one)) < 6_000 <= rows_read(plain.where(F.col("srcaddr") == one))


def test_distinct_on_ingest_is_trusted(spark, tmp_path):
    raw = inputs.azure_flow_logs_raw(spark, SMALL)
    flows = op.azure_flow_logs(raw.unionByName(raw.limit(50))).drop("properties", "flow_raw", "flow_tuples")
    key = ["recorded_at", "time_stamp", "event_time", "mac_address", "resource_id", "rule", "src_addr", "dst_addr", "src_port", "dst_port",
           "protocol", "traffic_flow", "traffic_decision", "flow_state", "packets_src_to_dst", "bytes_src_to_dst",
           "packets_dst_to_src", "bytes_dst_to_src"]
    kept = materialize(flows, path=str(tmp_path / "f"), date_column="recorded_at", distinct=key)
    again = spark.read.parquet(str(tmp_path / "f"))
    assert is_distinct(again, key) and is_distinct(again.where("src_port > 3"), [*key, "flow_mac"])
    assert not is_distinct(again, key[:-1]) and not is_distinct(again.drop("rule"), key) and not is_distinct(flows, key)
    lifetimes = spark.createDataFrame(
        [], "digest string, private_ip string, subscription_id string, window_start timestamp, window_end timestamp, nic_id string, "
        "nic_name string, nic_location string, nic_properties string, nic_tags map<string,string>, ip_configuration string, "
        "vm_tags map<string,string>, vm_id string, vm_name string, vm_properties string")
    trusted, plain = (op.azure_flow_logs_join_lifetimes(df, lifetimes) for df in (kept, flows))
    assert optimized(plain).count("Aggregate [") == optimized(trusted).count("Aggregate [") + 1
    keep = ["flow_recorded_at", "src_addr", "src_port", "dst_addr", "event_time", "flow_state", "rule"]
    assert as_set(trusted.select(*keep)) == as_set(plain.select(*keep))
    with pytest.raises(ValueError):
        materialize(flows, path=str(tmp_path / "g"), mode="append", distinct=key)


def test_admitted_and_quarantined_are_all(spark, tmp_path):
    """Malformed text, text of other types, and lines that are no JSON."""
    good = '{"category": "C", "properties": {"Version": 2, "flows": []}}'
    texts = [good, good[:30], '{"category": "C", "properties": {"Version": "x"}}', None, "{}", ""]
    raw = spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=timezone.utc), t) for t in texts], "recorded_at timestamp, flow_raw string")
    admitted, bad = admit(raw, "azure_flow_logs_raw", str(tmp_path / "a"))
    assert admitted.count() + bad.count() == len(texts) and admitted.columns == raw.columns
    assert {r.flow_raw for r in admitted.collect()} == {good, None, "{}"} or {r.flow_raw for r in admitted.collect()} == {good, None, "{}", ""}
    assert {r.bad_record for r in bad.collect()} == {"flow_raw"}
    lines = tmp_path / "lines.json"
    lines.write_text('{"account_id": "a", "configuration": {"x": 1}}\n{"account_id": "b", "configu\n{"account_id": "c", "recorded_at": "no time"}\n')
    read = read_source(spark, "aws_config", str(lines), "json", keep_corrupt=True)
    admitted, bad = admit(read, "aws_config", str(tmp_path / "b"))
    assert [r.account_id for r in admitted.collect()] == ["a"] and "_corrupt_record" not in admitted.columns
    assert [r.bad_record for r in bad.collect()] == ["line", "line"]
    assert admit(raw.limit(0), "azure_flow_logs_raw", str(tmp_path / "c"))[0].count() == 0


def test_records_without_json_are_admitted(spark, tmp_path):
    admitted, bad = admit(spark.createDataFrame([("1.1.1.1",)], "ioc_value string"), "iocs", str(tmp_path / "i"))
    assert admitted.count() == 1 and bad.count() == 0


@pytest.mark.parametrize(
    "name, column, counted",
    [
        ("azure_denied_baseline_rolling", "traffic_decision", "traffic_decision = 'DENIED'"),
        ("gcp_connect_baseline_rolling", "bytes", "start_time = end_time and bytes = 0"),
    ],
)
def test_rolling_queries_keep_only_what_they_count(spark, monkeypatch, name, column, counted):
    kept = []

    def keep(df):
        kept.append(cut_lineage(df))
        return kept[-1]

    monkeypatch.setattr(workload.queries, "cut_lineage", keep)
    workload.queries.QUERIES[name](spark, SMALL)
    flows = [df for df in kept if column in df.columns]
    assert len(flows) == 1 and not flows[0].isEmpty()
    assert flows[0].where(f"({counted}) is not true").isEmpty()


def test_admitted_records_are_written_small(spark, tmp_path):
    good, bad = admit(inputs.aws_config(spark, SMALL), "aws_config", str(tmp_path / "admitted"))
    assert good.count() and all(".zstd." in f for f in good.inputFiles())


def test_json_text_takes_no_part_in_the_joins_of_azure_flows(spark):
    """It is fetched by its digest, where it is asked for, and is what it was."""
    nics = op.azure_nics(inputs.azure_logs(spark, SMALL), inputs.azure_collect_network_interfaces(spark, SMALL), now=NOW)
    vms = op.azure_vms(inputs.azure_logs(spark, SMALL), inputs.azure_collect_virtual_machines(spark, SMALL), now=NOW)
    lifetimes = cut_lineage(op.azure_lifetimes(cut_lineage(op.azure_vms_nics(vms, nics))))
    flows = op.azure_flow_logs(inputs.azure_flow_logs_raw(spark, SMALL))
    joined = op.azure_flow_logs_join_lifetimes(flows, lifetimes, broadcast_limit=0)
    plan = plan_of(joined.select("src_addr", "src_vm_id", "dst_vm_tags"))
    assert "vm_id" in plan and not any(text in plan for text in ("vm_properties", "nic_properties", "ip_configuration"))
    sides = [joined.where(f"{s}_vm_id is not null").selectExpr(f"{s}_vm_id id", f"{s}_nic_id nic", f"{s}_vm_properties v", f"{s}_nic_properties n", f"{s}_ip_configuration i") for s in ("src", "dst")]
    found = sides[0].unionByName(sides[1]).distinct()
    stored = lifetimes.selectExpr("vm_id id", "nic_id nic", "vm_properties v", "nic_properties n", "ip_configuration i").distinct()
    assert found.count() and found.exceptAll(stored).isEmpty()
