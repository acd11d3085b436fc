"""Live operators with keyed state."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recspark.operators import ordering as od, stats as st
from recspark.schema import record_schema
from recspark.sources import streams as sm
from recspark.streaming import keyed, live

SCHEMA = record_schema([("stream", "Char", 8), ("Val", "Int64"), ("y", "Double"), ("a", "Float", 2)])
ORDER = ["TimeStamp", "Val"]


def rows(spark, lo, hi, streams=3):
    i = F.col("id")
    return spark.range(lo, hi).select(
        (10 + i / 2).cast("double").alias("TimeStamp"), F.concat(F.lit("s"), i % streams).alias("stream"), i.alias("Val"),
        F.when(i % 7 == 0, float("nan")).otherwise(F.sin(i)).alias("y"), F.array(i.cast("float"), F.lit(1.0).cast("float")).alias("a"),
    )


@pytest.fixture
def root(spark, tmp_path):
    sm.register_stream(spark, str(tmp_path / "r"), "s", SCHEMA)
    return str(tmp_path / "r")


def publish(spark, root, *spans):
    for lo, hi in spans:
        sm.publish(rows(spark, lo, hi).coalesce(1), root, "s")
        time.sleep(0.01)


def values(df, *names):
    return sorted(str(tuple(r)) for r in df.select(*names).collect())


def test_tails_count_what_they_drop():
    pdf = pd.DataFrame({"s": ["a"] * 5 + ["b"] + [None] * 3, "t": [5.0, 3, 4, 1, 2, 9, 7, 8, 6]})
    (out,) = keyed._tails(2, ["t"], ["s"])(iter([pdf]))
    got = sorted((str(r.s), r.t, r["__more"]) for _, r in out.iterrows())
    assert got == [("None", 7.0, 1), ("None", 8.0, 0), ("a", 4.0, 3), ("a", 5.0, 0), ("b", 9.0, 0)]


def test_latest_go_on_after_a_restart(spark, root, tmp_path):
    out, ckpt = str(tmp_path / "o"), str(tmp_path / "c")
    for spans in ([(200, 300), (0, 50)], [(50, 200)], [(300, 310)]):
        publish(spark, root, *spans)
        live.drain(live.latest_stream(sm.read_stream(spark, root, "s", 1), 8, out, ckpt, "stream", ORDER, state_partitions=2, available_now=True))
    want = od.latest(rows(spark, 0, 310), 8, ORDER, "stream")
    names = ("stream", "Val", "seq", "y", "a")
    assert values(live.read_result(spark, out), *names) == values(want, *names)


def test_only_touched_streams_are_written(spark, tmp_path):
    root, out, ckpt = (str(tmp_path / x) for x in "roc")
    sm.register_stream(spark, root, "s", SCHEMA)
    run = lambda: live.drain(live.latest_stream(sm.read_stream(spark, root, "s"), 3, out, ckpt, "stream", ORDER, state_partitions=2, available_now=True))
    sm.publish(rows(spark, 0, 4000, streams=1000), root, "s")
    run()
    sm.publish(rows(spark, 4000, 4001, streams=1000), root, "s")
    seen = []
    off = live.on_progress(spark, lambda p: seen.append(sum(o.numRowsUpdated for o in p.stateOperators)))
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    off()
    last = max(i for i, _, _ in live._versions(spark, out))
    assert spark.read.parquet(live._version(out, last)).count() == 3
    assert max(seen) <= 1 and live.read_result(spark, out).count() == 3000


def state_rows(spark, run):
    """The most entries of state that a query had after a micro-batch."""
    seen = []
    off = live.on_progress(spark, lambda p: seen.append(sum(o.numRowsTotal for o in p.stateOperators)))
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    off()
    return max(seen)


def test_streams_of_a_part_share_an_entry_and_keep_their_own_records(spark, tmp_path):
    root, out, ckpt = (str(tmp_path / x) for x in "roc")
    sm.register_stream(spark, root, "s", SCHEMA)
    run = lambda: live.drain(live.latest_stream(sm.read_stream(spark, root, "s"), 3, out, ckpt, "stream", ORDER, state_partitions=2, available_now=True))
    for lo, hi in ((0, 9000), (9000, 9100), (9100, 15000)):  # all streams, a few of them, nearly all
        sm.publish(rows(spark, lo, hi, streams=6000), root, "s")
        assert state_rows(spark, run) <= keyed.BUCKETS * keyed.PARTS < 6000
    names = ("stream", "Val", "seq", "y", "a")
    assert values(live.read_result(spark, out), *names) == values(od.latest(rows(spark, 0, 15000, streams=6000), 3, ORDER, "stream"), *names)


def test_running_records_of_many_streams_share_entries(spark, tmp_path):
    root, out, ckpt = (str(tmp_path / x) for x in "roc")
    sm.register_stream(spark, root, "s", SCHEMA)
    run = lambda: live.drain(
        live.running_stream(sm.read_stream(spark, root, "s"), "y", out, ckpt, "1 second", "stream", ORDER, state_partitions=2, available_now=True)
    )
    for lo, hi in ((0, 9000), (9000, 9100), (9100, 12000), (100_000, 100_001)):
        sm.publish(rows(spark, lo, hi, streams=6000), root, "s")
        # waiting records have an entry for numbers, pieces, and timers (two) in each bucket besides
        assert state_rows(spark, run) <= keyed.BUCKETS * (keyed.PARTS + 4) + 8
    names = ["stream", "Val", "count", F.round("mean", 9), F.round("min", 9), F.round("max", 9)]
    got, want = spark.read.parquet(f"{out}/*"), st.running_stats(rows(spark, 0, 12000, streams=6000), "y", ORDER, "stream")
    assert values(got.where("Val < 12000"), *names) == values(want, *names)


@pytest.mark.parametrize("by", ["stream", None])
def test_running_records_come_in_order_whatever_the_files_do(spark, root, tmp_path, by):
    out, ckpt = str(tmp_path / "o"), str(tmp_path / "c")
    run = lambda: live.drain(
        live.running_stream(sm.read_stream(spark, root, "s", 1), "y", out, ckpt, "130 seconds", by, ORDER, state_partitions=2, available_now=True)
    )
    publish(spark, root, (150, 250), (50, 150), (0, 50))
    run()
    publish(spark, root, (250, 260))
    run()  # goes on from the state
    early = spark.read.parquet(f"{out}/*").count()
    publish(spark, root, (100_000, 100_001))
    run()
    got = spark.read.parquet(f"{out}/*")
    want = st.running_stats(rows(spark, 0, 260), "y", ORDER, by)
    digits = [F.round(c, 9).alias(c) for c in ("mean", "min", "max")]
    assert early < 260 == got.count()
    assert values(got.select("stream", "Val", "count", *digits), "*") == values(want.select("stream", "Val", "count", *digits), "*")


@pytest.mark.parametrize("by", ["stream", None])
def test_batches_hold_n_records_whatever_the_files_hold(spark, root, tmp_path, by):
    ckpt, seen = str(tmp_path / "c"), []

    def keep(df, i):
        seen.extend((r.stream if by else "", r.batch, r.seq, r.Val) for r in df.collect())

    spans = [(0, 1), (1, 40), (40, 41), (41, 200), (200, 205)]
    for some in (spans[:2], spans[2:]):  # started again in between
        publish(spark, root, *some)
        live.drain(live.for_each_n(sm.read_stream(spark, root, "s", 1), 20, keep, ckpt, ORDER, by, state_partitions=2, available_now=True))
    want = od.batches(rows(spark, 0, 205), 20, ORDER, by)
    whole = {}
    for r in want.collect():
        whole.setdefault((r.stream if by else "", r.batch), []).append((r.seq, r.Val))
    assert sorted(seen) == sorted((s, b, *x) for (s, b), xs in whole.items() if len(xs) == 20 for x in xs)


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError), keyed.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        keyed.record_batches(spark.range(1), 0)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
