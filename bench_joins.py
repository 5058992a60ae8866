"""Time each rewritten join beside its literal form, on the same data: prints one JSON line.

`BENCH_SF_DIR` and `BENCH_CPUS` as in bench.py. The literal forms are what the rewrites must equal
(see tests/test_joins.py); they are here to be measured, not to be used.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark import operators as op
from flowspark.functions import in_window, minutes_between, timebound
from flowspark.session import local_session
from workload import inputs as i

NOW = i.NOW_TIME


def literal_peer_join(flows: DataFrame, instances: DataFrame) -> DataFrame:
    """Owner by id; peer by a condition over both addresses."""
    b = instances.select(F.col("instance_id").alias("b_id"), F.col("ip_address").alias("b_ip"))
    c = instances.select(
        F.col("instance_id").alias("c_id"), F.col("ip_address").alias("c_ip"), "window_start", "window_end"
    )
    at_time = (F.col("c_id") != F.col("instanceid")) & in_window(
        F.col("starttime"), F.col("window_start"), F.col("window_end")
    )
    src, dst = F.col("srcaddr"), F.col("dstaddr")
    match = F.when((src == F.col("b_ip")) & (dst == F.col("c_ip")) & at_time, 1).when(
        (dst == F.col("b_ip")) & (src == F.col("c_ip")) & at_time, 1
    )
    owned = flows.join(b, F.col("instanceid") == F.col("b_id"), "left")
    return owned.join(c, match == 1, "left")


def literal_ioc_join(flows: DataFrame, iocs: DataFrame) -> DataFrame:
    src, dst, ioc = F.col("srcaddr"), F.col("dstaddr"), F.col("ioc_value")
    return flows.join(iocs, ((src == ioc) & (F.col("action") == "ACCEPT")) | (dst == ioc))


def literal_beacons(flows: DataFrame) -> DataFrame:
    """All connections sorted by time, then grouped."""
    w = Window.partitionBy("instanceid", "dstaddr").orderBy(F.col("starttime").desc())
    recent = timebound(flows, "recorded_at", NOW, "4 hours").where(
        F.col("srcaddr").startswith("10.") & ~F.col("dstaddr").startswith("10.") & F.col("tcpflags").isin(2, 3)
    )
    gaps = recent.withColumn("later", F.lag("starttime").over(w)).where("later is not null")
    gap = minutes_between(F.col("starttime"), F.col("later"))
    return gaps.groupBy("instanceid", "srcaddr", "dstaddr").agg(
        F.count("*"), F.avg(gap), F.stddev(gap), F.variance(gap)
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    flows = i.aws_flow_logs_raw(spark, sf_dir)
    instances, iocs = i.aws_instances(spark, sf_dir), i.iocs(spark, sf_dir)
    beats = i.aws_beacon_flows(spark, sf_dir)
    anything = {"min_count": 0, "max_variance": 1e12, "min_gap": -1}
    forms = {
        "warm-up": lambda: flows,
        "peer, broadcast": lambda: op.aws_flow_logs_join_ec2(flows, instances),
        "peer, shuffled": lambda: op.aws_flow_logs_join_ec2(flows, instances, broadcast_limit=0),
        "peer, literal": lambda: literal_peer_join(flows, instances),
        "ioc, candidates": lambda: op.gcp_ioc_connections(
            flows.withColumnsRenamed({"srcaddr": "src_ip", "dstaddr": "dst_ip"}), iocs
        ),
        "ioc, literal": lambda: literal_ioc_join(flows, iocs),
        "beacons, by minute": lambda: op.aws_beaconing(beats, now=NOW, **anything),
        "beacons, literal": lambda: literal_beacons(beats),
    }
    seconds = {}
    for name, build in forms.items():
        began = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 2)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "join_seconds", "unit": "sec", "queries": seconds, "sf": float(Path(sf_dir).name[2:])}))


if __name__ == "__main__":
    main()
