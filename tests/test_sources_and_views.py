import os

import pytest
from conftest import NOW, plan_of
from pyspark.sql import functions as F

from flowspark import schemas
from flowspark.functions import timebound
from flowspark.operators import azure_denied_counts, azure_flow_logs
from flowspark.plans import VIEWS, FlowViews
from flowspark.sources import conform, cut_lineage, materialize, read_source
from workload import inputs

SMALL = "/root/testdata/sf0.001"


def test_read_parquet_casts_and_fills(spark, tmp_path):
    path = str(tmp_path / "iocs")
    spark.range(2).select(F.col("id").alias("ioc_value"), F.lit(1).alias("more")).write.parquet(path)
    df = read_source(spark, "iocs", path)
    assert df.dtypes == [("ioc_value", "string")] and df.count() == 2
    spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as recorded_at, 'x' as flow_raw").write.parquet(str(tmp_path / "f"))
    flows = read_source(spark, "azure_flow_logs_raw", str(tmp_path / "f"))
    assert dict(flows.dtypes)["recorded_at"] == "timestamp"
    assert dict(conform(flows, schemas.GCP_AUDIT_LOGS).dtypes)["log_type"] == "string"


def test_read_json_keeps_records_as_text(spark, tmp_path):
    path = tmp_path / "logs.json"
    path.write_text('{"recorded_at":"2024-01-01T00:00:00Z","flow_raw":{"category":"C","n":[1,2]}}\n')
    row = read_source(spark, "azure_flow_logs_raw", str(path), "json").first()
    assert row.flow_raw == '{"category":"C","n":[1,2]}'


def test_materialize_prunes_by_date(spark, tmp_path):
    df = spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400 + 1706000000).alias("recorded_at"), "id")
    back = materialize(df, path=str(tmp_path / "kept"), date_column="recorded_at")
    recent = timebound(back, "recorded_at", NOW, "2 days")
    assert "flowspark_recorded_day" in plan_of(recent).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.id for r in recent.collect()) == sorted(r.id for r in timebound(df, "recorded_at", NOW, "2 days").collect())


@pytest.mark.parametrize("writer, reader", [("America/Los_Angeles", "UTC"), ("UTC", "Asia/Kolkata"), ("Pacific/Auckland", "America/Los_Angeles")])
def test_pruning_does_not_depend_on_time_zones(spark, tmp_path, writer, reader):
    """48 hourly rows, written in one zone and read in another, with foreign date columns that say something else."""
    df = spark.range(48).select(
        F.timestamp_seconds(F.unix_seconds(F.lit(NOW)) - F.col("id") * 3600).alias("recorded_at"),
        "id",
        F.lit("1999-01-01").alias("recorded_date"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", writer)
        materialize(df, path=str(tmp_path / "kept"), date_column="recorded_at")
        spark.conf.set("spark.sql.session.timeZone", reader)
        back = spark.read.parquet(str(tmp_path / "kept"))
        for span, n in (("12 hours", 13), ("30 hours", 31)):
            assert timebound(back, "recorded_at", NOW, span).count() == n
            assert timebound(conform(back, "recorded_at timestamp, id long"), "recorded_at", NOW, span).count() == n
        assert timebound(back, "recorded_at", NOW, "30 hours", "6 hours").count() == 25
        assert "flowspark_recorded_day" in plan_of(timebound(back, "recorded_at", NOW, "12 hours")).split("PartitionFilters: [")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_foreign_dates_never_drop_rows(spark):
    df = spark.createDataFrame([(NOW, "1999-01-01", "1999-01-01")], "recorded_at timestamp, recorded_date string, flowspark_recorded_day string")
    assert timebound(df, "recorded_at", NOW, "1 hour").count() == 1
    assert conform(df, "recorded_at timestamp").columns == ["recorded_at"]


def test_a_day_can_be_written_again(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.range(30).select(F.timestamp_seconds(F.col("id") * 28800 + 1706140800).alias("recorded_at"), F.lit("flow").alias("log_type"), "id")
    materialize(df, path=path, date_column="recorded_at", partition_by=["log_type"])
    one = df.where("id between 3 and 5")  # the second day
    again = materialize(one.withColumn("id", F.col("id") + 1000), path=path, date_column="recorded_at", partition_by=["log_type"], mode="replace days")
    assert sorted(r.id for r in again.collect()) == sorted([*range(3), *range(6, 30), 1003, 1004, 1005])
    assert (tmp_path / "days" / "log_type=flow").is_dir()
    with pytest.raises(ValueError):
        materialize(df, table="days", date_column="recorded_at", mode="replace days")


def test_an_hour_skips_row_groups(spark, tmp_path):
    """Rows lie in order of time within a file, so row groups have narrow bounds."""
    import pyarrow.parquet as pq

    df = spark.range(40000).select(F.timestamp_seconds(1706140800 + F.pmod(F.col("id") * 7919, F.lit(40000)) * 2).alias("recorded_at"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    df = df.withColumn("x", F.repeat("x", 20))
    back = materialize(df, path=str(tmp_path / "k"), date_column="recorded_at")
    for file in back.inputFiles():
        times = pq.read_table(file.removeprefix("file://"), columns=["recorded_at"]).column(0).to_pylist()
        assert times == sorted(times)


def test_materialize_table_and_bad_target(spark):
    assert materialize(spark.range(3), table="kept_range").count() == 3
    with pytest.raises(ValueError):
        materialize(spark.range(3))
    with pytest.raises(ValueError):
        materialize(spark.range(3), table="other", date_column="id")


def test_partition_date_reaches_the_scan_through_the_flow_operators(spark, tmp_path):
    """Detections on dated raw logs prune, also above parsing and enrichment."""
    aws = materialize(inputs.aws_flow_logs_raw(spark, SMALL), path=str(tmp_path / "aws"), date_column="recorded_at")
    views = FlowViews({"aws_flow_logs_raw": aws}, now=NOW)
    azure = materialize(inputs.azure_flow_logs_raw(spark, SMALL), path=str(tmp_path / "azure"), date_column="recorded_at")
    sources = {**all_sources(spark), "azure_flow_logs_raw": azure}
    azure_views = FlowViews(sources, now=NOW)
    denied = azure_denied_counts(azure_views["azure_flow_logs_join_vm_nics"], NOW)
    for df in (views["aws_beaconing"], denied):
        assert "flowspark_recorded_day" in plan_of(df).split("PartitionFilters: [")[1].split("]")[0]
    assert azure_views["azure_denied_baseline"].count() == 4


def test_parsers_work_on_streams(spark, tmp_path):
    """They keep no state, so flows can be parsed as they arrive."""
    path = str(tmp_path / "raw")
    inputs.azure_flow_logs_raw(spark, SMALL).write.parquet(path)
    stream = spark.readStream.schema(schemas.AZURE_FLOW_LOGS_RAW).parquet(path)
    query = azure_flow_logs(stream).writeStream.format("memory").queryName("parsed").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table("parsed").count() == 17175


def test_cut_lineage_keeps_a_table_in_the_folder_of_the_session(spark):
    kept = cut_lineage(spark.range(5))
    assert kept.count() == 5
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder.removeprefix("file:") in kept.inputFiles()[0]


def all_sources(spark):
    names = ["aws_flow_logs_raw", "aws_config", "cloudtrail", "azure_logs", "azure_collect_network_interfaces",
             "azure_collect_virtual_machines", "azure_flow_logs_raw", "gcp_audit_logs", "gcp_cloud_assets", "iocs"]
    return {name: getattr(inputs, name)(spark, SMALL) for name in names}


def test_every_view_builds_from_the_sources(spark):
    views = FlowViews(all_sources(spark), now=NOW, keep_entities=True)
    assert set(views) == set(VIEWS)
    views.register()
    assert spark.table("aws_port_scanning").columns == views["aws_port_scanning"].columns
    assert spark.sql("select * from universal_flow_log").count() == 25231
    assert views["azure_port_scanning"].count() == 2
    assert views["gcp_port_scanning"].count() == 2


def test_detections_scan_their_flows_once(spark):
    """Baseline and detection read one table of counts; the counts read the raw flows once."""
    views = FlowViews(all_sources(spark), now=NOW)
    for counts, scan in (("azure_denied_counts", "azure_port_scanning"), ("gcp_miss_counts", "gcp_port_scanning")):
        files = set(views[counts].inputFiles())
        assert files and files <= set(views[scan].inputFiles())


def test_closing_removes_what_was_kept_and_now_is_fixed(spark):
    with FlowViews(all_sources(spark)) as views:
        kept = views["gcp_vms"].inputFiles()[0].removeprefix("file://")
        assert views._now.tzinfo is not None and os.path.exists(kept)
    assert not os.path.exists(kept)


def test_list_meets_flows_before_they_are_enriched(spark):
    """In the plan the listed addresses are joined beneath the join to lifetimes."""
    views = FlowViews(all_sources(spark), now=NOW)
    for cloud, end in (("aws", "_listed_srcaddr"), ("azure", "_listed_src_addr"), ("gcp", "_listed_src_ip")):
        plan = views[f"{cloud}_ioc_connections"]._jdf.queryExecution().optimizedPlan().toString().split("\n")
        depth = [min((len(line) - len(line.lstrip(" :+-")) for line in plan if "Join" in line and mark in line), default=None)
                 for mark in (end, "_candidate")]
        assert depth[0] is not None and depth[0] > depth[1]
        entity = [len(line) - len(line.lstrip(" :+-")) for line in plan if "Join LeftOuter" in line and "_listed" not in line]
        assert max(entity) < depth[0]


def test_conditions_stand_below_the_joins(spark, tmp_path):
    """Filtered flows are the flows of the filtered view, and the filter is beneath every join."""
    sources = {n: all_sources(spark)[n] for n in ("aws_flow_logs_raw", "aws_config", "cloudtrail")}
    sources["aws_flow_logs_raw"] = materialize(sources["aws_flow_logs_raw"], path=str(tmp_path / "flows"))
    with FlowViews(sources, now=NOW, where={"aws_flow_logs": "action = 'ACCEPT' and dstport = 443"}) as some, FlowViews(sources, now=NOW) as every:
        name = "aws_flow_logs_join_ec2"
        assert some[name].count() == every[name].where("action = 'ACCEPT' and dstport = 443").count() > 0
        plan = some[name]._jdf.queryExecution().optimizedPlan().toString().split("\n")
        deep = lambda mark: [len(line) - len(line.lstrip(" :+-")) for line in plan if mark in line]
        assert min(deep("= 443")) > max(deep("Join LeftOuter"))


def test_look_backs_side_by_side(spark):
    sources = {n: all_sources(spark)[n] for n in ("aws_config", "cloudtrail")}
    for span, suffix in (("30 days", ""), ("5 days", "_5d")):
        FlowViews(sources, now=NOW, options={"aws_instances": {"lookback": span}}).register(suffix)
    assert 0 < spark.table("aws_instances_5d").count() < spark.table("aws_instances").count()


def test_closing_removes_kept_lifetimes(spark):
    with FlowViews(all_sources(spark), now=NOW) as views:
        kept = [f for f in views["azure_flow_logs_join_vm_nics"].inputFiles() if "kept-" in f]
        assert kept and all(os.path.exists(f.removeprefix("file://")) for f in kept)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in kept)


def test_views_of_one_cloud_only(spark):
    views = FlowViews({"aws_flow_logs_raw": inputs.aws_flow_logs_raw(spark, SMALL)}, now=NOW)
    assert list(views) == ["aws_flow_logs", "aws_beaconing"]
    with pytest.raises(KeyError):
        views["aws_port_scanning"]
