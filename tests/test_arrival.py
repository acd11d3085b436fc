"""The arrival log: positions of records in the order in which they came."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from recspark.schema import record_schema
from recspark.sources import arrival, paths, streams as sm

SCHEMA = record_schema([("v", "Int64")])


@pytest.fixture
def root(spark, tmp_path):
    sm.register_stream(spark, str(tmp_path), "s", SCHEMA)
    return str(tmp_path)


def rows(spark, lo, hi, time=5.0, parts=1):
    return spark.range(lo, hi, 1, parts).select(F.lit(time).alias("TimeStamp"), F.col("id").alias("v"))


def arrived(spark, root):
    return [(r.position, r.v) for r in sm.read_arrivals(spark, root, "s").orderBy("position").collect()]


def opened(df):
    return [f for f in df.inputFiles() if f.endswith(".parquet")]  # entries of the log are read too


def test_equal_times_come_back_in_the_order_of_arrival(spark, root):
    assert arrived(spark, root) == [] and sm.end_position(spark, root, "s") == 0
    assert sm.slice_published(spark, root, "s", 0).columns == ["TimeStamp", "v", "position"]
    for lo in (300, 0, 200, 100):  # as many files as a publish has partitions
        assert sm.publish(rows(spark, lo, lo + 100, parts=3), root, "s") == 100
    want = list(enumerate([*range(300, 400), *range(100), *range(200, 300), *range(100, 200)]))
    assert arrived(spark, root) == want and sm.end_position(spark, root, "s") == 400
    got = [(r.position, r.v) for r in sm.published_between(spark, root, "s", 5.0, 5.0).collect()]
    assert got == want
    assert sm.read_table(spark, root, "s").columns == ["TimeStamp", "v"]


def test_a_slice_opens_only_the_files_it_hits(spark, root):
    for lo in range(0, 100, 10):
        sm.publish(rows(spark, lo, lo + 10, time=float(lo)), root, "s")
    for lo, count, files in ((0, 10, 1), (5, 10, 2), (95, 50, 1), (25, 40, 5), (-3, None, 1), (200, 5, 0), (40, 0, 0)):
        part = sm.slice_published(spark, root, "s", lo, count)
        first = 97 if lo < 0 else lo
        assert [r.v for r in part.collect()] == list(range(first, min(100, 100 if count is None else first + count)))
        assert len(opened(part)) == files or not files
    part = sm.published_between(spark, root, "s", 20.0, 45.0)
    assert [r.v for r in part.collect()] == list(range(20, 50)) and len(opened(part)) == 3


def test_publishers_at_once_share_no_position(spark, root):
    def publish(k):
        for i in range(4):
            sm.publish(rows(spark, 1000 * k + 10 * i, 1000 * k + 10 * i + 5 + k), root, "s")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(publish, range(4)))
    got = arrived(spark, root)
    assert [p for p, _ in got] == list(range(4 * (5 + 6 + 7 + 8)))
    order = [v for _, v in got]
    for k in range(4):
        own = [v for v in order if v // 1000 == k]
        assert own == sorted(own) and len(own) == 4 * (5 + k)


def test_only_one_gets_a_name(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: paths.write_exclusive(spark, f"{tmp_path}/log/x", str(i)), range(40)))
    assert sum(won) == 1 and paths.read_text(spark, f"{tmp_path}/log/x") == str(won.index(True))


@pytest.mark.parametrize("failing", ["write_exclusive", "_commit", "move"])
def test_a_retried_batch_adds_its_records_once(spark, root, monkeypatch, failing):
    sm.publish(rows(spark, 0, 3), root, "s")
    real = getattr(arrival, failing)

    def fail(*args):
        if failing == "write_exclusive":
            real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(arrival, failing, fail)
    with pytest.raises(RuntimeError):
        sm.publish(rows(spark, 3, 8), root, "s", batch=0)
    monkeypatch.setattr(arrival, failing, real)
    for _ in range(2):
        sm.publish(rows(spark, 3, 8), root, "s", batch=0)
    sm.publish(rows(spark, 8, 9), root, "s")
    assert arrived(spark, root) == [(i, i) for i in range(9)]
    assert sm.read_table(spark, root, "s").count() == 9


def test_a_claimed_publish_is_finished_by_the_next_reader(spark, root, monkeypatch):
    monkeypatch.setattr(arrival, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sm.publish(rows(spark, 0, 4), root, "s")
    monkeypatch.undo()
    assert [r.v for r in sm.slice_published(spark, root, "s", 1, 2).collect()] == [1, 2]
    monkeypatch.setattr(arrival, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sm.publish(rows(spark, 4, 8), root, "s")
    monkeypatch.undo()
    assert len(arrived(spark, root)) == 4  # never claimed
    monkeypatch.setattr(arrival, "FORGOTTEN", -1e9)
    arrival.settle(spark, sm.stream_path(root, "s"))
    assert not [n for n, _ in paths.entries(spark, sm.stream_path(root, "s")) if n.startswith(arrival.STAGED)]


def test_entries_list_files_with_bounds(spark, root):
    sm.publish(rows(spark, 0, 10, time=1.5, parts=2), root, "s")
    sm.publish(rows(spark, 0, 0), root, "s")
    path = sm.stream_path(root, "s")
    (entry,) = arrival.log(spark, path).collect()
    assert (entry.n, entry.first, entry["count"]) == (0, 0, 10)
    assert [(f.first, f["count"], f.low, f.high) for f in entry.files] == [(0, 5, 1.5, 1.5), (5, 5, 1.5, 1.5)]
    assert json.loads(paths.read_text(spark, f"{path}/_log/000000000000.json"))["folder"] == entry.folder
