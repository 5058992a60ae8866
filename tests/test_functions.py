from datetime import datetime, timedelta

from conftest import NOW
from pyspark.sql import functions as F

from flowspark import functions as f


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def ts(text):
    return F.lit(text).cast("timestamp")


def test_minutes_are_boundaries_crossed(spark):
    row = one(
        spark,
        f.minutes_between(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")).alias("a"),
        f.minutes_between(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")).alias("b"),
        f.minutes_between(ts("2024-01-01 00:02:00"), ts("2024-01-01 00:01:59")).alias("c"),
        f.minutes_between(ts("2024-01-01 00:02:00"), F.lit(None).cast("timestamp")).alias("d"),
    )
    assert tuple(row) == (1, 0, -1, None)


def test_tags_to_map(spark):
    df = spark.createDataFrame(
        [
            (1, None),
            (2, []),
            (3, [{"k": "a", "v": "1"}, {"k": "b", "v": "2"}, {"k": "a", "v": "3"}]),
            (4, [{"k": "a"}, {"v": "1"}, {"k": "c", "v": "9"}]),
            (5, [{"k": "a", "v": None}]),
        ],
        "n int, tags array<map<string,string>>",
    )
    got = {r.n: r.m for r in df.select("n", f.tags_to_map(F.col("tags"), "k", "v").alias("m")).collect()}
    assert got == {1: None, 2: {}, 3: {"a": "3", "b": "2"}, 4: {"c": "9"}, 5: {"a": None}}
    assert list(got[3]) == ["a", "b"]


def test_timebound_keeps_both_ends_and_prunes_dates(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 30, h),) for h in (0, 1, 23)], "recorded_at timestamp")
    assert f.timebound(df, "recorded_at", NOW, "23 hours").count() == 2
    assert f.timebound(df, "recorded_at", NOW, timedelta(hours=24), "23 hours").count() == 2
    dated = df.withColumn("flowspark_recorded_day", f.day_index(F.col("recorded_at")))
    bounded = f.timebound(dated, "recorded_at", NOW, "23 hours")
    assert "flowspark_recorded_day" in bounded._jdf.queryExecution().analyzed().toString().split("Filter")[1].split("+-")[0]


def test_default_now_is_the_clock(spark):
    df = spark.range(1).select(F.current_timestamp().alias("recorded_at"))
    assert f.timebound(df, "recorded_at", None, "1 hour").count() == 1


def test_in_window(spark):
    t, start, end, null = ts("2024-01-02"), ts("2024-01-01"), ts("2024-01-02"), F.lit(None).cast("timestamp")
    row = one(
        spark,
        f.in_window(t, start, end).alias("inside"),
        f.in_window(t, start, null).alias("open"),
        f.in_window(t, start, null, open_end=False).alias("closed"),
        f.in_window(t, null, end).alias("no_start"),
    )
    assert tuple(row) == (True, True, None, None)


def test_launch_instant_reads_iso_seconds_and_milliseconds(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "1704067200", "1704067200000", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_seconds(f.launch_instant(F.col("t")))).collect()]
    assert got == [1704067200] * 4 + [None, None]


def test_nth(spark):
    row = one(spark, f.nth(F.lit("a/b"), "/", 1).alias("x"), f.nth(F.lit("a.b"), ".", 5).alias("y"))
    assert tuple(row) == ("b", None)


def test_canonical_json(spark):
    texts = ['{"b":1, "a":[1, 2]}', '{ "a":[1,2],"b":1}', "null", "{broken", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(f.canonical_json(F.col("t"))).collect()]
    assert got == ['{"a":[1,2],"b":1}'] * 2 + [None] * 3


def test_json_is_parsed_once_under_filters(spark):
    df = spark.createDataFrame([('{"a": "1", "b": ["x", "y", null]}',), ("{",), (None,)], "t string")
    parsed = f.parse_once(df, "t", "a string, b array<string>", "r")
    plan = parsed.where("r.a = '1' and r.a is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert parsed.count() == 3
    exploded = f.explode_parsed(
        df.select(F.from_json("t", "a string, b array<string>").alias("r")), F.col("r.b"), "x"
    )
    assert exploded._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [r.x for r in exploded.collect()] == ["x", "y"]


def test_tag_lists_are_read_once(spark):
    texts = ['[{"k": "a", "v": "1"}, {"k": "b", "v": null}, {"k": "a", "v": "2"}, {"v": "3"}, {"k": "c"}]', "[]", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("doc", f.document(F.col("t")))
    read = df.select(f.tags_to_map(f.field(F.col("doc"), "$", "array<map<string,string>>"), "k", "v").alias("m"))
    assert read._jdf.queryExecution().optimizedPlan().toString().count("variant_get") == 1
    assert [r.m for r in read.collect()] == [{"a": "2", "b": None}, {}, None]


def test_columns_apart_are_not_merged_into_parsers(spark):
    df = spark.createDataFrame([("1", 2), (None, 3)], "a string, n int")
    built = df.select(F.when(F.col("a").isNotNull(), F.to_json(F.struct("a"))).alias("t"), "n")
    parsed = f.apart(built, "t").select(F.from_json("t", "a string").alias("r"), "n")
    lines = parsed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("from_json" in line and "StructsToJson" in line for line in lines)
    assert [(r.r and r.r.a, r.n) for r in parsed.collect()] == [("1", 2), (None, 3)]
