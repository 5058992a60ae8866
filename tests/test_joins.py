"""The join rewrites against their literal forms, on small random data with nulls and repeats."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import as_set, plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowspark.functions import in_window
from flowspark.operators.joins import (
    _edges,
    _packed,
    both_ends_join,
    both_lifetimes_join,
    candidate_join,
    id_join,
    is_small,
    lifetime_join,
    merge_lifetimes,
    next_start,
    size_by,
)

BASE = datetime(2024, 1, 1)


def maybe(rng, value, share=0.1):
    return None if rng.random() < share else value


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_candidate_join_equals_or(spark, seed, limit):
    rng = random.Random(seed)
    ip = lambda: maybe(rng, f"ip{rng.randrange(6)}")
    flows = spark.createDataFrame(
        [(n, ip(), ip(), maybe(rng, rng.random() < 0.5)) for n in range(60)],
        "n int, src string, dst string, fine boolean",
    )
    listed = spark.createDataFrame([(ip(),) for _ in range(8)], "ioc_value string")
    got = candidate_join(flows, listed, "ioc_value", "src", "dst", F.col("fine"), limit)
    literal = flows.join(
        listed,
        ((F.col("src") == F.col("ioc_value")) & F.col("fine")) | (F.col("dst") == F.col("ioc_value")),
    )
    assert as_set(got) == as_set(literal)
    assert "BroadcastNestedLoopJoin" not in plan_of(got)


NAMES = dict(left_ip="ip", left_time="t", right_ip="addr", right_start="s", right_end="u")


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("limit, part_bytes", [(1 << 20, 1 << 20), (1 << 20, 100), (0, 1 << 20), (0, 100)])
@pytest.mark.parametrize("open_end", [True, False])
@pytest.mark.parametrize("addresses", [4, 1])
def test_lifetime_join_equals_literal(spark, seed, limit, part_bytes, open_end, addresses):
    """As it is, packed, and packed in several parts an address, with few and many holders."""
    rng = random.Random(seed)
    at = lambda: BASE + timedelta(minutes=rng.randrange(-2000, 9000) * 7)
    ip = lambda: maybe(rng, f"ip{rng.randrange(addresses)}")
    left = spark.createDataFrame([(n, ip(), maybe(rng, at()), "x") for n in range(120)], "n int, ip string, t timestamp, `a.b` string")
    right = spark.createDataFrame(
        [(e, ip(), maybe(rng, at()), maybe(rng, at(), 0.3), {"k": str(e)}) for e in range(60)],
        "e int, addr string, s timestamp, u timestamp, m map<string,string>",
    )
    got = lifetime_join(
        left, right, **NAMES, spread_by=["n"], condition=lambda held: held["e"] != F.col("n"),
        open_end=open_end, size=size_by(right, "addr"), broadcast_limit=limit, part_bytes=part_bytes,
    )
    within = in_window(F.col("t"), F.col("s"), F.col("u"), open_end)
    literal = left.join(right, (F.col("ip") == F.col("addr")) & within & (F.col("e") != F.col("n")), "left")
    assert as_set(got) == as_set(literal)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_an_address_with_many_holders(spark, limit):
    """An address passed on 100,000 times: each row meets one part of its holders, and parts repeat none but those on an edge."""
    held = spark.range(100_000).select(
        F.col("id").alias("e"),
        F.lit("hot").alias("addr"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 30).alias("s"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 30 + 29).alias("u"),
    )
    seen = spark.range(50_000).select(
        F.col("id").alias("n"), F.lit("hot").alias("ip"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60 + 7).alias("t")
    )
    size = size_by(held, "addr")
    assert size.largest == size.total
    got = lifetime_join(seen, held, **NAMES, spread_by=["n"], size=size, broadcast_limit=limit)
    found = got.agg(F.count("*"), F.count_if(F.col("e") == F.col("n") * 2)).first()
    assert tuple(found) == (50_000, 50_000)
    packed = _packed(held, _edges(held, "addr", "s", 64 << 10), "addr", "s", "u")
    sizes = [r[0] for r in packed.select(F.size("_lives")).collect()]
    assert len(sizes) > 40 and sum(sizes) <= 100_000 + len(sizes) and max(sizes) < 5_000


def test_long_lives_are_not_repeated_for_their_time(spark):
    """Lifetimes of years are packed once each, unless their address has too many of them."""
    right = spark.range(1000).select(
        "id", F.concat(F.lit("ip"), F.col("id") % 300).alias("addr"), F.lit(BASE).alias("s"), F.lit(None).cast("timestamp").alias("u")
    )
    packed = _packed(right, None, "addr", "s", "u")
    assert packed.select(F.sum(F.size("_lives"))).first()[0] == 1000 and packed.count() == 300


@pytest.mark.parametrize("small", [True, False])
def test_id_join_spreads_nulls_and_never_matches_them(spark, small):
    left = spark.createDataFrame([(n, None if n % 3 else f"i{n}") for n in range(30)], "n int, id string")
    right = spark.createDataFrame([("i0", 1), ("i0", 2), (None, 3), ("\u00005", 4)], "rid string, v int")
    got = id_join(left, right, "id", "rid", ["n"], small)
    literal = left.join(right, F.col("id") == F.col("rid"), "left")
    assert as_set(got) == as_set(literal)


@pytest.mark.parametrize("seed", range(3))
def test_next_start_equals_lead(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(
        [
            (n, maybe(rng, f"k{min(rng.randrange(6), 2)}"), maybe(rng, BASE + timedelta(minutes=20 * rng.randrange(40))),
             maybe(rng, n * 7))
            for n in range(200)
        ],
        "n int, k string, t timestamp, v int",
    )
    got = next_start(df, "k", "t", ["n"], "v", "following")
    w = Window.partitionBy("k").orderBy("t", "n")
    known = F.col("k").isNotNull() & F.col("t").isNotNull()
    literal = df.where(known).withColumn("following", F.lead("v").over(w))
    assert as_set(got) == as_set(literal.unionByName(df.where(~known).withColumn("following", F.lit(None).cast("int"))))


@pytest.mark.parametrize("seed", range(3))
def test_merged_lifetimes_match_the_same_times_once(spark, seed):
    rng = random.Random(seed)
    spans = [
        (f"p{rng.randrange(3)}", maybe(rng, rng.randrange(50)), maybe(rng, rng.randrange(60), 0.1), "c")
        for _ in range(25)
    ]
    at = lambda h: None if h is None else BASE + timedelta(hours=h)
    df = spark.createDataFrame(
        [(p, at(s), at(u), c) for p, s, u, c in spans], "p string, s timestamp, u timestamp, c string"
    )
    merged = merge_lifetimes(df, ["p"], "s", "u", carry=["c"])
    times = spark.createDataFrame([(at(h),) for h in range(70)], "t timestamp")
    within = in_window(F.col("t"), F.col("s"), F.col("u"))
    got = times.join(merged, within).select("t", "p", "c")
    assert as_set(got) == as_set(times.join(df, within).select("t", "p", "c").distinct())


def test_is_small_measures(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "a string")
    assert is_small(df, 2000) and not is_small(df, 1000)
    assert is_small(df.limit(0), 0)


def test_hot_id_is_split_by_adaptive_execution(spark):
    """A third of the rows share one id: the shuffled join splits its partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("i"), F.col("id"))).alias("key")
        )
        right = spark.createDataFrame([("hot", 1), ("i1", 2)], "rid string, v int")
        joined = id_join(left, right, "key", "rid", ["id"])
        assert joined.where("v is not null").count() == 20001
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _shuffled_records(plan):
    """Records that exchanges of a plan that ran wrote; a reused one counts once."""
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    children = plan.children()
    return own + sum(_shuffled_records(children.apply(i)) for i in range(children.size()))


def test_both_ends_join_shuffles_rows_with_one_id_once(spark):
    """As two left joins, duplicates and absent ids included; but of 95 rows with an id or none 90 are shuffled once."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    ids = [("a", None)] * 40 + [(None, "b")] * 40 + [(None, None)] * 10 + [("a", "b"), ("a", "a"), ("b", "gone"), ("gone", "b"), ("gone", "gone")]
    left = spark.createDataFrame([(n, *pair) for n, pair in enumerate(ids)], "n int, src string, dst string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, v int")
    ends = {"src_": "src", "dst_": "dst"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plain = left
        for prefix, end in ends.items():
            one = right.select(F.col("id").alias("rid"), F.col("v").alias(f"{prefix}v"))
            plain = plain.join(one, F.col(end) == F.col("rid"), "left").drop("rid")
        got = both_ends_join(left, right, ends, "id", ["n"])
        assert got.columns == plain.columns and as_set(got) == as_set(plain)
        assert as_set(both_ends_join(left, right, ends, "id", ["n"], small=True)) == as_set(plain)
        got.collect()
        # 95 rows by their first id and 7 met ones with both by their second, and the entities for each end.
        assert _shuffled_records(got._jdf.queryExecution().executedPlan()) <= 95 + 7 + 2 * 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_absent_addresses_share_no_window(spark):
    """However many rows have no key or no time, none of them is sorted with another thousand."""
    rows = [(n, None, BASE, n) for n in range(5000)] + [(n, "k", None, n) for n in range(5000, 10000)] + [(10000, "k", BASE, 1)]
    df = spark.createDataFrame(rows, "n int, k string, t timestamp, v int")
    got = next_start(df, "k", "t", ["n"], "v", "following")
    assert got.where("following is not null").count() == 0 and got.count() == len(rows)


def test_beaconing_sorts_one_row_a_minute(spark):
    """40,000 sources of an unknown host reach one destination: statistics are right and the window has a row a minute."""
    from flowspark.operators.beaconing import beacons

    flows = spark.range(80_000).select(
        F.lit("-").alias("host"),
        F.concat(F.lit("s"), F.col("id") % 40_000).alias("src"),
        F.lit("d").alias("dst"),
        F.timestamp_seconds(1_700_000_000 + F.pmod(F.col("id") * 7919, F.lit(14_400))).alias("began"),
    ).withColumn("ended", F.col("began") + F.expr("interval 90 seconds"))
    found = beacons(flows, host="host", src="src", dst="dst", start="began", end="ended", min_count=0, max_variance=1e9, min_gap=-1)
    w = Window.partitionBy("host", "dst").orderBy("began", "took", "src")
    minute = F.floor(F.unix_seconds("began") / 60)
    took = F.floor(F.unix_seconds("ended") / 60) - minute
    literal = flows.withColumn("took", took).withColumn("gap", F.floor(F.unix_seconds(F.lead("began").over(w)) / 60) - minute).where("gap is not null")
    literal = literal.groupBy("src").agg(F.count("*").alias("n"), F.avg("gap").alias("gap"), F.variance("gap").alias("v"))
    mine = found.select("src", F.col("beacon_count").alias("n"), F.col("avg_prev_time_diff").alias("gap"), F.col("variance_prev_time_diff").alias("v"))
    assert mine.count() == literal.where("n > 1").count()
    joined = literal.alias("l").join(mine.alias("m"), "src").where("l.n <> m.n or abs(l.gap - m.gap) > 1e-9 or abs(l.v - m.v) > 1e-6")
    assert joined.count() == 0


FLOWS = {"host": "host", "src": "src", "dst": "dst"}
ALL = {"min_count": 0, "max_variance": 1e12, "min_gap": -1}


@pytest.mark.parametrize("seed", range(3))
def test_any_cut_of_time_gives_the_same_beacons(spark, seed):
    """Stretches of any length, joined or not, fold to the statistics of the flows, also with hosts, ends or times missing."""
    from flowspark.operators.beaconing import beacon_stretches, beacons, beacons_of, joined_stretches

    rng = random.Random(seed)
    began = lambda: BASE + timedelta(seconds=rng.randrange(6 * 3600))
    rows = [
        (maybe(rng, f"h{rng.randrange(2)}"), f"s{rng.randrange(3)}", f"d{rng.randrange(2)}", maybe(rng, began(), 0.05))
        for _ in range(300)
    ]
    rows = [(*r, None if r[3] is None or rng.random() < 0.2 else r[3] + timedelta(seconds=rng.randrange(300))) for r in rows]
    flows = spark.createDataFrame(rows, "host string, src string, dst string, began timestamp, ended timestamp")
    times = {"start": "began", "end": "ended"}
    whole = as_set(beacons(flows, **FLOWS, **times, **ALL))
    assert whole
    for minutes in (1, 7, 60, 10_000):
        assert as_set(beacons_of(beacon_stretches(flows, **FLOWS, **times, minutes=minutes), **FLOWS, **ALL)) == whole
    quarters = beacon_stretches(flows, **FLOWS, **times, minutes=15)
    hours = joined_stretches(quarters, **FLOWS, ratio=4)
    assert as_set(hours) == as_set(beacon_stretches(flows, **FLOWS, **times))
    assert as_set(beacons_of(joined_stretches(hours, **FLOWS, ratio=24), **FLOWS, **ALL)) == whole


def test_kept_hours_order_one_row_a_stretch(spark):
    """However many sources a destination has, only the rows with an open end are sorted together."""
    from flowspark.operators.beaconing import beacon_stretches, beacons_of

    flows = spark.range(20_000).select(
        F.lit("h").alias("host"),
        F.concat(F.lit("s"), F.col("id")).alias("src"),
        F.lit("d").alias("dst"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") % 14_400).alias("began"),
    )
    hours = beacon_stretches(flows.withColumn("ended", F.col("began")), **FLOWS, start="began", end="ended")
    assert hours.where("edge is not null").count() <= 5 and hours.count() >= 20_000
    assert beacons_of(hours, **FLOWS, **ALL).count() == 0


def test_rows_without_an_address_meet_in_no_task(spark):
    """Where no address is cut into parts, too: all parts are 0 there, and a constant is no key."""
    left = spark.range(400).selectExpr("if(id % 10 = 0, cast(id as string), null) as ip", "timestamp_seconds(id) as ts", "cast(id as int) as n")
    right = spark.range(400).selectExpr("cast(id as string) as addr", "timestamp_seconds(id - 5) as start_ts", "cast(null as timestamp) as end_ts", "id as holder")
    kept = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lifetime_join(
            left, right, left_ip="ip", left_time="ts", right_ip="addr", right_start="start_ts", right_end="end_ts",
            spread_by=["n"], size=size_by(right, "addr"), broadcast_limit=0,
        )
        rows = got.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    lost = [r["task"] for r in rows if r["ip"] is None]
    assert len(lost) == 360 and all(lost.count(task) < 180 for task in lost)
    assert sorted((r["n"], r["holder"]) for r in rows if r["ip"] is not None) == [(n, n) for n in range(0, 400, 10)]


ENDS = dict(ends={"src": "src", "dst": "dst"}, left_time="t", right_ip="addr", right_start="s", right_end="u", identity="e", spread_by=["n"])


@pytest.mark.parametrize("part_bytes", [1 << 20, 100])
def test_both_lifetimes_join_equals_two_joins_of_distinct_rows(spark, part_bytes):
    rng = random.Random(part_bytes)
    at = lambda: BASE + timedelta(minutes=rng.randrange(9000) * 7)
    ip = lambda: maybe(rng, f"{rng.choice(['10.0.0', '10.0.1', '192.0.2'])}.{rng.randrange(2)}")
    flows = [(n % 50, ip(), ip(), maybe(rng, at()), maybe(rng, rng.randrange(3))) for n in range(150)]
    left = spark.createDataFrame(flows + flows[::2], "n int, src string, dst string, t timestamp, port int")
    lives = [(n % 12, f"10.0.{rng.randrange(2)}.{rng.randrange(2)}", at(), maybe(rng, at(), 0.3), rng.randrange(3), {"k": str(n % 12)}) for n in range(60)]
    right = spark.createDataFrame(lives, "e int, addr string, s timestamp, u timestamp, sub int, m map<string,string>")
    right = merge_lifetimes(right, ["e", "addr", "sub"], "s", "u", ["m"]).withColumnRenamed("m", "tags")
    size = size_by(right, "addr")
    got = both_lifetimes_join(
        left, right, **ENDS, condition=lambda held: held["sub"] == F.col("n") % 3, size=size, distinct=False, part_bytes=part_bytes
    )
    literal = left
    for end, extra in (("src", F.col("src_sub") == F.col("n") % 3), ("dst", F.lit(True))):
        side = right.withColumnsRenamed({c: f"{end}_{c}" for c in right.columns})
        alive = in_window(F.col("t"), F.col(f"{end}_s"), F.col(f"{end}_u"))
        literal = literal.join(side, (F.col(end) == F.col(f"{end}_addr")) & alive & extra, "left")
    seen = ["n", "src", "dst", "t", "port", "src_e", "src_addr", F.col("src_tags.k").alias("src_k"), "dst_e", "dst_addr", F.col("dst_tags.k").alias("dst_k")]
    assert as_set(got.select(*seen)) == as_set(literal.select(*seen).distinct())


def test_rows_with_one_held_address_are_shuffled_once(spark):
    """Made distinct, too; and no end of rows is built into a hash map."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    outside = [("10.0.0.1", "192.0.2.1"), ("192.0.2.1", "10.0.0.1"), ("192.0.2.1", "192.0.2.2"), (None, "10.0.0.1")]
    ends = [pair for pair in outside for _ in range(50)] + [("10.0.0.1", "10.0.0.2")] * 5
    left = spark.createDataFrame([(n, *pair, BASE) for n, pair in enumerate(ends)], "n int, src string, dst string, t timestamp")
    right = spark.createDataFrame([(e, f"10.0.0.{e}", BASE, None) for e in (1, 2)], "e int, addr string, s timestamp, u timestamp")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = both_lifetimes_join(left, right, **ENDS, condition=lambda held: F.lit(True), size=size_by(right, "addr"), distinct=False)
        assert {(r.n, r.src_e, r.dst_e) for r in got.collect()} == {
            (n, int(s[-1]) if s and s[0] == "1" and s[1] == "0" else None, int(d[-1]) if d[1] == "0" else None) for n, (s, d) in enumerate(ends)
        }
        # 205 rows by one address and 5 by the second, and the entities and their networks for each branch.
        assert _shuffled_records(got._jdf.queryExecution().executedPlan()) <= 205 + 5 + 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_are_not_built_into_hash_maps(spark):
    """Adaptive execution knows the size of what was shuffled, and built maps of the rows beside the packed lifetimes."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left = spark.range(500).selectExpr("cast(id % 50 as string) as ip", "timestamp_seconds(id) as t", "id as n")
    right = spark.range(50).selectExpr("cast(id as string) as addr", "timestamp_seconds(0) as s", "cast(null as timestamp) as u", "id as e")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = lifetime_join(left, right, **NAMES, spread_by=["n"], size=size_by(right, "addr"), broadcast_limit=0)
        assert len(got.collect()) == 500
        assert "ShuffledHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
