from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recspark.operators import ordering as od
from recspark.operators import stats as st
from recspark.plans import ranges, suite
from recspark.plans.ranges import key_ranges
from recspark.schema import record_schema

ORDER = ["TimeStamp", "Val"]


def stream(spark, n, parts=4, stamp=lambda c: c.cast("double")):
    """Val 0..n-1 in stream order, with its rows shuffled."""
    df = spark.range(n).select(stamp(F.col("id")).alias("TimeStamp"), F.col("id").cast("int").alias("Val"))
    return df.repartition(parts, F.hash("Val"))


def hot(spark, n):
    """One stream with a third of all rows, many small ones, few distinct times."""
    df = stream(spark, n, stamp=lambda c: (c / 100).cast("int").cast("double"))
    return df.withColumn("stream", F.when(F.col("Val") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("Val") % 40)))


@pytest.mark.parametrize("parts", [1, 4, 13])
@pytest.mark.parametrize("n_ranges", [1, 3, 50])
def test_positions_of_ten_thousand(spark, parts, n_ranges):
    df = od.with_seq(stream(spark, 10_000, parts), ORDER, n_ranges=n_ranges)
    assert df.count() == 10_000
    assert df.where("seq <> Val").count() == 0


@pytest.mark.parametrize("stamp", [lambda c: F.lit(1.0), lambda c: F.when(c < 3333, 1.0).otherwise(c.cast("double"))])
def test_equal_times_are_cut_by_the_next_column(spark, stamp):
    df = stream(spark, 10_000, stamp=stamp)
    ranges = key_ranges(df, ORDER, 32)
    assert max(od.range_counts(df, ranges)) < 1_500
    assert od.with_seq(df, ORDER, n_ranges=32).where("seq <> Val").count() == 0


def test_cuts_from_a_sample_give_the_same_positions(spark, monkeypatch):
    monkeypatch.setattr(ranges, "SAMPLE_ROWS", 300)
    df = stream(spark, 10_000, stamp=lambda c: F.when(c < 5_000, 1.0).otherwise(c.cast("double")))
    cut = key_ranges(df, ORDER, 16)
    assert cut.count > 8 and max(od.range_counts(df, cut)) < 3_000
    assert od.with_seq(df, ORDER, n_ranges=16).where("seq <> Val").count() == 0


@pytest.mark.parametrize("dtype", ["int", "bigint", "float", "decimal(20,0)", "date", "timestamp", "timestamp_ntz"])
def test_positions_by_other_key_types(spark, dtype):
    time = {"date": F.date_add(F.lit("2024-01-01"), F.col("Val"))}.get(
        dtype, F.timestamp_seconds("Val").cast(dtype) if "time" in dtype else F.col("Val").cast(dtype)
    )
    df = stream(spark, 500).withColumn("k", time)
    assert od.with_seq(df, "k", n_ranges=7).where("seq <> Val").count() == 0
    got = od.slice_records(df, 100, 50, "k", n_ranges=7)
    assert sorted(r["Val"] for r in got.collect()) == list(range(100, 150))


def test_local_times_know_no_time_zone(spark):
    texts = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "1960-01-01 00:00:00.000001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [str(r[0]) for r in df.select(ranges.local_seconds(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["1710037800.123456", "1730597400.000000", "-315619199.999999"]


def test_nan_and_null_times_keep_their_rows(spark):
    df = spark.createDataFrame([(float("nan"), 4), (None, 0), (1.0, 1), (2.0, 2), (float("inf"), 3)], "TimeStamp double, Val int")
    got = od.with_seq(df, ORDER, n_ranges=4)
    assert got.where("seq <> Val").count() == 0 and got.count() == 5
    assert [r["Val"] for r in od.slice_records(df, 0, 2, ORDER, n_ranges=4).collect()] == [0, 1]
    assert [r["Val"] for r in od.latest(df, 2, ORDER, n_ranges=4).collect()] == [3, 4]


def test_null_tie_breakers_keep_their_rows(spark):
    df = spark.range(100).select(F.lit(1.0).alias("TimeStamp"), F.when(F.col("id") > 0, F.col("id")).alias("Val"))
    got = od.with_seq(df, ORDER, n_ranges=8)
    assert got.where("seq <> coalesce(Val, 0)").count() == 0
    for lo, n in ((0, 5), (0, 100), (10, 20), (95, 5)):
        assert [r["seq"] for r in od.slice_records(df, lo, n, ORDER, n_ranges=8).collect()] == list(range(lo, lo + n))


def test_empty_stream(spark):
    df = stream(spark, 0)
    assert od.with_seq(df, ORDER).count() == 0
    assert od.latest(df, 5, ORDER).count() == 0
    assert od.read_after(df, 3, order_by=ORDER).columns == ["TimeStamp", "Val", "seq"]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_per_stream_positions_with_a_hot_stream(spark, limit):
    df = hot(spark, 6_000)
    rows = od.with_seq(df, ORDER, "stream", n_ranges=9, max_group_rows=limit).collect()
    assert len(rows) == 6_000
    per = {}
    for r in sorted(rows, key=lambda r: r["Val"]):
        assert r["seq"] == per.get(r["stream"], 0)
        per[r["stream"]] = r["seq"] + 1


def test_null_stream_names_count_as_one_stream(spark):
    df = spark.createDataFrame([(float(i), i, None if i % 2 else "a") for i in range(20)], "TimeStamp double, Val int, stream string")
    for limit in (0, 100):
        rows = od.with_seq(df, ORDER, "stream", n_ranges=3, max_group_rows=limit).collect()
        assert sorted((r["Val"], r["seq"]) for r in rows) == [(i, i // 2) for i in range(20)]
        last = od.latest(df, 2, ORDER, "stream", n_ranges=3, max_group_rows=limit).collect()
        assert sorted(r["Val"] for r in last) == [16, 17, 18, 19]


def test_batches_hold_n_records(spark):
    sizes = od.batches(stream(spark, 1_050), 200, ORDER).groupBy("batch").count().orderBy("batch").collect()
    assert [(r[0], r[1]) for r in sizes] == [(0, 200), (1, 200), (2, 200), (3, 200), (4, 200), (5, 50)]


def test_small_ring_keeps_the_newest(spark):
    schema = record_schema([("Val", "Int32")])
    df = spark.createDataFrame([(float(v), v) for v in (1, 2, 3, 4)], schema)
    assert [(r["Val"], r["seq"]) for r in od.latest(df, 3, ORDER).collect()] == [(2, 1), (3, 2), (4, 3)]
    assert [r["Val"] for r in od.latest(df, 10, ORDER).collect()] == [1, 2, 3, 4]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_latest_per_stream(spark, limit):
    df = hot(spark, 3_000)
    got = od.latest(df, 7, ORDER, "stream", n_ranges=5, max_group_rows=limit).collect()
    all_rows = {}
    for r in sorted(df.collect(), key=lambda r: r["Val"]):
        all_rows.setdefault(r["stream"], []).append(r["Val"])
    want = [(s, v, len(vs) - 7 + i) for s, vs in sorted(all_rows.items()) for i, v in enumerate(vs[-7:])]
    assert [(r["stream"], r["Val"], r["seq"]) for r in got] == want


def test_slice_of_tens(spark):
    df = spark.createDataFrame([(float(i), v) for i, v in enumerate((10, 20, 30, 40, 50))], record_schema([("Val", "Int32")]))
    assert [r["Val"] for r in od.slice_records(df, 1, 1, ORDER).collect()] == [20]
    assert [r["Val"] for r in od.slice_records(df, 3, 10, ORDER).collect()] == [40, 50]
    assert od.slice_records(df, 5, 3, ORDER).count() == 0


@pytest.mark.parametrize("step", [200, 1_000])
def test_reading_on_from_a_cursor_loses_nothing(spark, step):
    df, seen, cursor = stream(spark, 2_500).persist(), [], 0
    while rows := od.read_after(df, cursor, step, ORDER).collect():
        seen += sorted(r["Val"] for r in rows)
        cursor += len(rows)
    assert seen == list(range(2_500))
    df.unpersist()


def test_per_stream_slices(spark):
    df = hot(spark, 600)
    got = od.slice_records(df, 2, 3, ORDER, "stream").groupBy("stream").agg(F.min("seq"), F.max("seq"), F.count("*"))
    assert {tuple(r)[1:] for r in got.collect()} == {(2, 4, 3)}


def test_head_and_concat(spark):
    df = stream(spark, 100)
    assert [r["Val"] for r in od.head(df, 5, ORDER).collect()] == [0, 1, 2, 3, 4]
    both = od.concat([df, df.select("Val", "TimeStamp")])
    assert both.count() == 200 and both.agg(F.sum("Val")).first()[0] == 9900


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_never_meet_in_one_partition(spark):
    df = stream(spark, 100)
    assert "SinglePartition" not in plan(od.with_seq(df, ORDER))
    assert "SinglePartition" not in plan(od.latest(df, 9, ORDER))
    # here only the totals of the ranges meet, one row each
    before, single, after = plan(st.running_stats(df, "Val", ORDER)).partition("SinglePartition")
    assert "SinglePartition" not in after and after.index("HashAggregate") < after.index("Scan" if "Scan" in after else "Range")


def test_latest_reads_only_the_tail(spark, tmp_path):
    stream(spark, 1_000).write.parquet(str(tmp_path / "t"))
    tail = od.latest(spark.read.parquet(str(tmp_path / "t")), 10, ORDER)
    assert "PushedFilters: [IsNotNull(TimeStamp), GreaterThanOrEqual(TimeStamp," in plan(tail)


def test_results_come_in_order_without_adaptive_plans(spark):
    df = stream(spark, 5_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert [r["seq"] for r in od.read_after(df, 3_739, order_by=ORDER, n_ranges=32).collect()] == list(range(3_739, 5_000))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ranges_fill_as_many_even_tasks(spark):
    df = od.with_seq(stream(spark, 64_000), ORDER, n_ranges=32)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 32 and max(sizes) <= 1.5 * 2_000


def test_the_number_of_ranges_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 100)
    assert ranges.default_ranges(spark.range(1), 5_000) == 50
    assert key_ranges(stream(spark, 5_000), ORDER).count == 50


@pytest.mark.parametrize("limit", [0, 10**9])
def test_text_and_flags_order_streams_of_any_size(spark, limit):
    names = ["", "a", "aaaaaaaab", "aaaaaaaac", "é", "zz", None, "☃"]
    df = spark.range(400).select((F.col("id") % 2).alias("s"), F.get(F.array(*map(F.lit, names)), (F.hash("id") % 8 + 8) % 8).alias("t"), (F.col("id") % 3 == 0).alias("f"), "id")
    for order in (["t", "id"], ["f", "id"], ["f", "t", "id"]):
        got = od.with_seq(df, order, "s", max_group_rows=limit, n_ranges=6)
        place = {None: b"", **{n: n.encode() for n in names if n is not None}}
        rows = sorted(df.collect(), key=lambda r: [(r[c] is not None, place[r[c]] if c == "t" else r[c]) for c in order])
        want = {r["id"]: [x["id"] for x in rows if x["s"] == r["s"]].index(r["id"]) for r in rows}
        assert {r["id"]: r["seq"] for r in got.collect()} == want
    assert [r["seq"] for r in od.slice_records(df, 100, 50, ["t", "id"], n_ranges=5).collect()] == list(range(100, 150))


def test_texts_with_one_prefix_fill_even_ranges(spark):
    urls = spark.range(20_000).select(F.format_string("https://a.very.long.host.example.org/one/path/%06d", F.col("id") * 7919 % 20_000).alias("url"), "id")
    sizes = od.range_counts(urls, key_ranges(urls, ["url", "id"], 32))
    assert len(sizes) == 32 and max(sizes) <= 1.5 * 20_000 / 32
    same = urls.withColumn("url", F.lit("https://a.very.long.host.example.org/"))
    assert max(od.range_counts(same, key_ranges(same, ["url", "id"], 32))) <= 1.5 * 20_000 / 32
    assert od.with_seq(urls, ["url"], n_ranges=32).where(F.col("seq") != F.col("id") * 7919 % 20_000).count() == 0


KEYS = {
    "struct": "named_struct('a', cast(id div 50 as int), 'b', concat('x', lpad(id % 50, 2, '0')))",
    "array": "case when id < 100 then array(cast(null as bigint), id) else array(id div 20, id) end",
    "days": "make_dt_interval(cast(id div 24 as int), cast(id % 24 as int), 0, 0.000001)",
    "months": "make_ym_interval(0, cast(id as int) - 50)",
    "binary": "unhex(lpad(hex(id + 100), 4, '0'))",
    "decimal": "cast(id as decimal(38,9)) / 1000",
    "flag": "id >= 150",
    "nan": "case when id >= 300 then double('NaN') when id >= 250 then double('Infinity') when id < 10 then null else cast(id as double) end",
    "micros": "timestamp_micros(1700000000000000 + id)",
    "early": "timestamp_ntz'0001-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.000001)",
}


@pytest.mark.parametrize("limit", [0, 10**9])
@pytest.mark.parametrize("kind", KEYS)
def test_keys_of_any_sortable_type(spark, kind, limit):
    df = spark.range(400).select(F.expr(KEYS[kind]).alias("k"), "id", (F.col("id") % 2).alias("s")).repartition(3)
    got = od.with_seq(df, ["k", "id"], "s", max_group_rows=limit, n_ranges=9)
    assert got.where("seq <> id div 2").count() == 0 and got.count() == 400
    if not limit:
        assert od.with_seq(df, ["k", "id"], n_ranges=9).where("seq <> id").count() == 0
        assert key_ranges(df, ["k", "id"], 9).count == 9
        assert [r["id"] for r in od.slice_records(df, 90, 120, ["k", "id"], n_ranges=9).select("id").collect()] == list(range(90, 210))
        assert [r["id"] for r in od.latest(df, 30, ["k", "id"], n_ranges=9).select("id").collect()] == list(range(370, 400))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["range_filter", "visible_range", "slice_records", "read_after", "latest_global"])
def test_time_bounds_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = suite.QUERIES[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert any("ThanOrEqual(ts" in line for line in plan.splitlines() if "PushedFilters" in line), plan
