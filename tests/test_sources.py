import os
import struct
import subprocess
import sys
import time
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.plans import suite
from recspark.schema import record_schema
from recspark.sources import exchange as ex, paths, recordings as rec, streams as sm

ENGINE = record_schema([("SensorValue", "Int32"), ("Voltage", "Double")])


def every_type(spark, n):
    schema = record_schema(
        [
            ("A", "Int8", 2), ("U", "UInt64"), ("W", "UInt8", ["tx", "rx", "4", "err"]), ("S", "Char", 6), ("B", "Bool"),
            ("F", "Float"), ("U4", "UInt32"), ("L", "UInt64", ["b0", "62", "b63"]), ("D", "Double"), ("I", "Int64"),
        ]
    )
    rows = [
        (
            float(i), [i % 128, -(i % 100)], Decimal(2**64 - 1 - i), i % 256, f"é{i % 100}", i % 2 == 0, i / 4, 2**32 - 1 - i, -1 - i,
            float("nan") if i == 3 else 1.5 * i, i - 2**62,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schema)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("align", [False, True])
@pytest.mark.parametrize("split", [331, 1 << 20])
def test_round_trip_of_every_type(spark, tmp_path, align, split):
    df = every_type(spark, 1_000).repartition(3)
    path = str(tmp_path / "rec")
    rec.write_recordings(df, path, "Engine_1", align=align)
    back = rec.read_recordings(spark, path, splitBytes=split)
    assert back.schema["W"].metadata == df.schema["W"].metadata
    assert back.select("_alias").distinct().collect()[0][0] == "Engine_1"
    assert same(back.select(df.columns), df.persist())
    spots = back.groupBy("_file").agg(F.count("*").alias("n"), F.countDistinct("_pos").alias("d"), F.max("_pos").alias("m"))
    assert spots.where("n <> d or m <> n - 1").count() == 0


def test_sections_of_a_recording(spark, tmp_path):
    df = spark.createDataFrame([(123456789.0, 42, 3.14), (123456790.0, 100, 5.55)], ENGINE).coalesce(1)
    path = str(tmp_path / "rec")
    rec.write_recordings(df, path, "Engine_1")
    got = rec.sections(spark, path).orderBy("idx").collect()
    assert [(r["idx"], r["type"], r["name"], r["n_fields"], r["rec_size"], r["n_records"]) for r in got] == [
        (0, "Header", "Engine_1", 3, 20, 0), (1, "Data", "Engine_1", 3, 20, 2),
    ]
    assert got[1]["body_length"] == 2 * got[1]["rec_size"]


def test_unknown_sections_are_listed_and_skipped(spark, tmp_path):
    path = tmp_path / "rec"
    rec.write_recordings(spark.createDataFrame([(1.0, 2, 3.0)], ENGINE).coalesce(1), str(path))
    file = next(path.glob("*.rec"))
    whole = file.read_bytes()
    file.write_bytes(whole + struct.pack("<HHQ12s", 0x5243, 9, 5, b"note") + b"hello" + whole)
    assert [r["type"] for r in rec.sections(spark, str(path)).orderBy("idx").collect()] == ["Header", "Data", "Unknown(9)", "Header", "Data"]
    assert [r["_pos"] for r in rec.read_recordings(spark, str(path)).orderBy("_pos").collect()] == [0, 1]


def test_many_data_sections(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rec, "SECTION_BYTES", 5_000)
    df = spark.range(5_000).select(
        (F.col("id") + 100000).cast("double").alias("TimeStamp"), F.col("id").cast("int").alias("Counter"), (F.col("id") * 0.5).alias("SineValue")
    )
    with pytest.MonkeyPatch.context() as m:
        m.setattr(rec, "SECTION_BYTES", 5_000)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 300)
        try:
            rec.write_recordings(df.coalesce(1), str(tmp_path / "rec"), "IntgrTest")
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rec.sections(spark, str(tmp_path / "rec")).where("type = 'Data'").count() > 10
    back = rec.read_recordings(spark, str(tmp_path / "rec"), splitBytes=7_001)
    assert same(back.select(df.columns), df)
    assert back.where("_pos <> Counter").count() == 0


def test_empty_and_missing_recordings(spark, tmp_path):
    df = spark.createDataFrame([], record_schema([("Val", "Int32")]))
    rec.write_recordings(df.coalesce(1), str(tmp_path / "rec"))
    assert rec.read_recordings(spark, str(tmp_path / "rec")).count() == 0
    with pytest.raises(Exception, match="no recording at"):
        rec.read_recordings(spark, str(tmp_path / "nope")).count()


def test_broken_files_are_errors(spark, tmp_path):
    for name, data in (("junk", b"x" * 100), ("short", b"x" * 10)):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="no section|cut off"):
            rec.read_recordings(spark, str(tmp_path / name)).count()


def test_append_overwrite_and_nothing_left_behind(spark, tmp_path):
    df, path = spark.createDataFrame([(1.0, 2, 3.0)], ENGINE), str(tmp_path / "rec")
    rec.write_recordings(df, path)
    rec.write_recordings(df, path)
    assert rec.read_recordings(spark, path).count() == 2
    rec.write_recordings(df, path, mode="overwrite")
    assert rec.read_recordings(spark, path).count() == 1
    assert all(p.name.endswith(".rec") for p in (tmp_path / "rec").iterdir())


def test_chosen_fields(spark, tmp_path):
    rec.write_recordings(spark.createDataFrame([(1.0, 2, 3.0)], ENGINE), str(tmp_path / "rec"))
    back = rec.read_recordings(spark, str(tmp_path / "rec"), fields="Voltage,TimeStamp")
    assert [tuple(r)[:2] for r in back.collect()] == [(3.0, 1.0)]


@pytest.mark.parametrize(
    "spec, value", [(("W", "UInt8"), 256), (("W", "UInt16"), -1), (("S", "Char", 2), "abc"), (("A", "Int8", 2), [1]), (("V", "Int32"), None)]
)
def test_values_that_do_not_fit_fail_the_write(spark, tmp_path, spec, value):
    schema = record_schema([spec])
    loose = spark.createDataFrame([(0.0, value)], f"TimeStamp double, `{spec[0]}` {schema[spec[0]].dataType.simpleString()}")
    df = sm.with_fields(loose, schema)
    with pytest.raises(Exception, match="does not fit|longer than|must hold|no nulls"):
        rec.write_recordings(df, str(tmp_path / "rec"))
    assert not list((tmp_path / "rec").glob("*.rec")) if (tmp_path / "rec").exists() else True


def csv_lines(path):
    return [p.read_text().splitlines() for p in sorted(path.glob("*.csv"))]


def test_csv_format_and_append(spark, tmp_path):
    schema = record_schema([("ID", "Int32"), ("Value", "Double")])
    df = spark.createDataFrame([(1.0, 10, 3.14), (1.0, 20, 0.005)], schema).coalesce(1)
    ex.write_csv(df.select("ID", "TimeStamp", "Value"), str(tmp_path / "c"))
    assert csv_lines(tmp_path / "c") == [["TimeStamp,ID,Value", "1.000000,10,3.140000", "1.000000,20,0.005000"]]
    ex.write_csv(spark.createDataFrame([(1.0, 2, 2.2)], schema).coalesce(1), str(tmp_path / "c"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert rows.count() == 3 and rows.where("ID = 2").first()["Value"] == "2.200000"


def test_csv_of_an_empty_stream_has_its_header(spark, tmp_path):
    schema = record_schema([("ColInt", "Int32"), ("ColDbl", "Double")])
    ex.write_csv(spark.createDataFrame([], schema).coalesce(1), str(tmp_path / "c"))
    assert csv_lines(tmp_path / "c") == [["TimeStamp,ColInt,ColDbl"]]


def test_csv_arrays_and_special_numbers(spark, tmp_path):
    schema = record_schema([("A", "Float", 2), ("N", "Int8", 2), ("V", "Double")])
    rows = [(1.0, [0.5, float("inf")], [1, -2], float("nan")), (2.0, [0.25, float("-inf")], [3, 4], -1.0)]
    ex.write_csv(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "c"))
    assert csv_lines(tmp_path / "c")[0] == [
        "TimeStamp,A[0],A[1],N[0],N[1],V", "1.000000,0.500000,inf,1,-2,nan", "2.000000,0.250000,-inf,3,4,-1.000000",
    ]


def test_two_streams_in_the_catalog(spark, tmp_path):
    root, schema = str(tmp_path / "s"), record_schema([("SensorValue", "Double"), ("W", "UInt8", ["a", "2", "b"])])
    assert sm.catalog(spark, root).count() == 0
    for name in ("BufferA", "BufferB"):
        sm.register_stream(spark, root, name, schema)
        sm.register_stream(spark, root, name, schema)
    rows = sm.catalog(spark, root).collect()
    assert sorted((r["stream"], r["pos"], r["field"], r["src_type"]) for r in rows) == sorted(
        (s, *f) for s in ("BufferA", "BufferB") for f in ((0, "TimeStamp", "Double"), (1, "SensorValue", "Double"), (2, "W", "UInt8"))
    )
    assert rows[2]["bits"] == {"a": 0, "b": 3}
    assert sm.catalog(spark, root, "nope").count() == 0
    assert sm.stream_schema(spark, root, "BufferA") == schema
    with pytest.raises(ValueError):
        sm.register_stream(spark, root, "BufferA", ENGINE)


def test_publish_counts_and_checks(spark, tmp_path):
    root = str(tmp_path / "s")
    sm.register_stream(spark, root, "Live/1", record_schema([("Value", "Double"), ("N", "UInt8")]))
    df = spark.range(50).select((F.col("id") * 1.1).alias("Value"), F.col("id").alias("N"), F.col("id").cast("double").alias("TimeStamp"))
    assert sm.publish(df, root, "Live/1") == 50
    assert sm.publish(df.limit(0), root, "Live/1") == 0
    got = {r["TimeStamp"]: r["Value"] for r in sm.read_table(spark, root, "Live/1").collect()}
    assert got[0.0] == 0.0 and got[10.0] == pytest.approx(11.0) and len(got) == 50
    for bad in (df.drop("Value"), df.withColumn("more", F.lit(1))):
        with pytest.raises(ValueError):
            sm.publish(bad, root, "Live/1")
    for bad in (df.withColumn("N", F.lit(300)), df.withColumn("Value", F.lit(None).cast("double"))):
        with pytest.raises(Exception, match="does not fit|no nulls"):
            sm.publish(bad, root, "Live/1")
    assert sm.read_table(spark, root, "Live/1").count() == 50
    with pytest.raises(LookupError):
        sm.publish(df, root, "nope")
    with pytest.raises(ConnectionError):
        sm.read_table(spark, root, "nope")


def test_publish_fills_in_the_time(spark, tmp_path):
    root = str(tmp_path / "s")
    sm.register_stream(spark, root, "a", record_schema([("Value", "Double")]))
    sm.publish(spark.createDataFrame([(1.0,)], "Value double"), root, "a")
    assert sm.read_table(spark, root, "a").first()["TimeStamp"] > 1.7e9


def test_producers(spark):
    schema = record_schema([("Sample", "Float"), ("Index", "UInt32")])
    df = ex.from_producer(spark, schema, lambda i: {"Sample": np.sin(0.01 * i), "Index": i}, 1_000)
    assert df.schema == schema and df.count() == 1_000
    row = df.where("Index = 700").first()
    assert row["Sample"] == pytest.approx(np.sin(7.0), rel=1e-6) and row["TimeStamp"] > 1.7e9
    some = ex.from_producer(spark, schema, ex.each_record(lambda i: {"Sample": 1.0, "Index": i} if i % 4 else None), 100)
    assert some.count() == 75
    with pytest.raises(Exception, match="made"):
        ex.from_producer(spark, schema, lambda i: {"Sample": np.zeros(len(i) + 1), "Index": 1}, 10).count()


def test_snapshot_to_pandas(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i, 0.5) for i in range(20)], ENGINE)
    assert list(ex.to_frame(df, 3)["SensorValue"]) == [17, 18, 19]
    rec.write_recordings(df, str(tmp_path / "rec"))
    assert list(ex.to_frame(str(tmp_path / "rec"), 2, spark=spark)["SensorValue"]) == [18, 19]
    with pytest.raises(TypeError):
        ex.to_frame(42)


def test_arrays_of_wide_and_flag_types(spark, tmp_path):
    schema = record_schema([("U", "UInt64", 2), ("B", "Bool", 3), ("U2", "UInt16", 2), ("C", "Char"), ("D", "Double", 2)])
    rows = [(0.0, [Decimal(2**64 - 1), Decimal(0)], [True, False, True], [65535, 0], "é", [0.5, -1.0]), (1.0, [Decimal(7), Decimal(8)], [False] * 3, [1, 2], "", [1.0, 2.0])]
    df = spark.createDataFrame(rows, schema)
    rec.write_recordings(df, str(tmp_path / "rec"))
    back = rec.read_recordings(spark, str(tmp_path / "rec")).orderBy("TimeStamp").collect()
    assert [tuple(r)[:6] for r in back] == rows
    # the same records through a named stream
    root = str(tmp_path / "s")
    sm.register_stream(spark, root, "wide", schema)
    assert sm.publish(df, root, "wide") == 2
    assert [tuple(r) for r in sm.read_table(spark, root, "wide").orderBy("TimeStamp").collect()] == rows


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_publish_changes_no_value(spark, tmp_path, ansi):
    schema = record_schema([("a", "Int8"), ("c", "Char", 2), ("u", "UInt16"), ("xs", "Int16", 2)])
    root = str(tmp_path / "r")
    sm.register_stream(spark, root, "s", schema)
    good = [1.0, 3.0, "ab", 65535, [1, -2]]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = lambda row: spark.createDataFrame([tuple(row)], "TimeStamp double, a double, c string, u long, xs array<long>")
        assert sm.publish(frame(good), root, "s") == 1
        for at, bad in ((1, 3.9), (1, 300.0), (2, "toolong"), (2, "a\0"), (3, -1), (3, 70_000), (4, [1, 40_000]), (4, [1]), (4, [1, None]), (1, None)):
            with pytest.raises(Exception, match="fit|nulls|length"):
                sm.publish(frame([*good[:at], bad, *good[at + 1 :]]), root, "s")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert sm.read_table(spark, root, "s").count() == 1


def test_two_registrations_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    schema = record_schema([("a", "Int8")])
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: sm.register_stream(spark, str(tmp_path / "r"), f"s{i % 4}", schema), range(8)))
    assert sm.catalog(spark, str(tmp_path / "r")).count() == 8


def test_csv_gives_text_and_odd_numbers_back(spark, tmp_path):
    schema = record_schema([("c", "Char", 20), ("xs", "Double", 3)])
    rows = [(1.0, '  a, "b" ', [float("inf"), float("-inf"), 0.5]), (2.0, "", [1.0, 2.0, 3.0])]
    ex.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "c"))
    back = ex.read_csv(spark, str(tmp_path / "c"), schema)
    assert sorted((r[0], r[1], r[2]) for r in back.collect()) == rows and back.schema["xs"].metadata == schema["xs"].metadata


def test_csv_of_long_arrays(spark, tmp_path):
    schema = record_schema([("c", "Char", 20), ("xs", "Float", 2_000), ("n", "Int16", 2)])
    rows = [(float(i), f'{i}\\ "q", é', [i + 0.25] * 1_999 + [float("nan")], [i, -i]) for i in range(200)]
    start = time.perf_counter()
    ex.write_csv(spark.createDataFrame(rows, schema).repartition(3), str(tmp_path / "c"))
    back = ex.read_csv(spark, str(tmp_path / "c"), schema).orderBy("TimeStamp").collect()
    assert time.perf_counter() - start < 10  # seconds; an expression per element took a minute
    assert [(r[0], r[1], r[2][:-1], r[3]) for r in back] == [(t, c, xs[:-1], n) for t, c, xs, n in rows]
    assert all(r[2][-1] != r[2][-1] for r in back)
    lines = csv_lines(tmp_path / "c")
    assert sum(map(len, lines)) == 203 and all(x[0].split(",")[:3] == ["TimeStamp", "c", "xs[0]"] for x in lines)
    other = spark.read.option("header", True).csv(str(tmp_path / "c"))  # as any reader of CSV sees it
    assert len(other.columns) == 2_004 and sorted(r[0] for r in other.select("c").collect()) == sorted(r[1] for r in rows)
    ex.write_csv(spark.createDataFrame([], schema).coalesce(1), str(tmp_path / "e"))
    assert len(csv_lines(tmp_path / "e")[0]) == 1 and ex.read_csv(spark, str(tmp_path / "e"), schema).count() == 0


def test_csv_values_that_do_not_fit_are_null(spark, tmp_path):
    schema = record_schema([("xs", "Int8", 2), ("c", "Char", 3)])
    (tmp_path / "a.csv").write_text("TimeStamp,xs[0],xs[1],c\n1.5,x,3,\n2.5,4\n")
    assert [tuple(r) for r in ex.read_csv(spark, str(tmp_path), schema).orderBy("TimeStamp").collect()] == [(1.5, [None, 3], ""), (2.5, [4], "")]


def test_blocks_without_records(spark):
    schema = record_schema([("a", "Int64")])
    out = ex.from_producer(spark, schema, ex.each_record(lambda i: None), 10)
    assert out.count() == 0


def test_a_whole_snapshot(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("TimeStamp"), "id")
    assert len(ex.to_frame(df, None)) == 20_000 and ex.to_arrow(df, None)["id"].to_pylist() == list(range(20_000))
    with pytest.raises(TypeError):
        ex.to_frame(df)


def test_a_whole_recording_stays_in_the_tasks(spark, tmp_path, monkeypatch):
    sf, path = str(tmp_path / "sf"), str(tmp_path / "rec")
    spark.range(500).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
        F.lit("a").alias("event_type"), F.col("id").cast("double").alias("value"),
    ).write.parquet(f"{sf}/events.parquet")
    rec.write_recordings(suite.events(spark, sf), path, "Events")
    for held in (ex.to_arrow(path, None, ["TimeStamp", "event_id"], spark).to_pandas(), ex.to_frame(path, None, ["TimeStamp", "event_id"], spark)):
        assert held["event_id"].tolist() == list(range(500))  # the helpers hold a bounded recording

    def refused(*args, **kwargs):
        raise AssertionError("the driver holds the recording")

    with monkeypatch.context() as m:
        for name in ("toArrow", "toPandas", "collect"):
            m.setattr(type(spark.range(1)), name, refused)
        got = suite.whole_recording(spark, sf)
    assert sorted((r.event_id, r.value) for r in got.collect()) == [(i, float(i)) for i in range(500)]


def test_paths_mean_what_they_mean_to_spark(spark, tmp_path):
    for path in (str(tmp_path / "x"), f"file:{tmp_path}/x", f"file://{tmp_path}/x"):
        assert paths.open_fs(paths.readable(spark, path))[1] == f"{tmp_path}/x"
    assert paths.open_fs("s3a://b/x")[0].type_name == "s3" if paths_s3() else True
    for refused in ("dbfs:/x", "/bare", "viewfoo://a/b"):
        with pytest.raises(Exception):
            paths.open_fs(paths.readable(spark, refused) if ":" in refused else refused)
    with pytest.raises(Exception, match="full URI"):
        rec.register(spark)
        spark.read.format("records").load(str(tmp_path))


def paths_s3():
    try:
        paths.open_fs("s3a://b/x")
    except Exception:
        return False
    return True


def test_text_with_a_nul_is_refused(spark, tmp_path):
    schema = record_schema([("c", "Char", 4)])
    for bad in ("a\0b", "abcde", "☃"):
        with pytest.raises(Exception, match="NUL|longer|Latin"):
            rec.write_recordings(spark.createDataFrame([(1.0, bad)], schema), str(tmp_path / "n"))


def test_publish_takes_frames_tables_and_arrays(spark, tmp_path):
    import pandas as pd
    import pyarrow as pa

    root = str(tmp_path / "r")
    sm.register_stream(spark, root, "s", record_schema([("a", "Int32"), ("xs", "Double", 2)]))
    pdf = pd.DataFrame({"TimeStamp": [1.0, 2.0], "a": [1, 2], "xs": [[1.0, 2.0], [3.0, 4.0]]})
    records = np.zeros(3, [("TimeStamp", "<f8"), ("a", "<i4"), ("xs", "<f8", (2,))])
    records["a"] = [3, 4, 5]
    assert sm.publish(pdf, root, "s") == 2
    assert sm.publish(pa.Table.from_pandas(pdf.assign(a=[6, 7])), root, "s") == 2
    assert sm.publish(records, root, "s") == 3
    assert sorted(r["a"] for r in sm.read_table(spark, root, "s").collect()) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(TypeError):
        sm.publish(np.zeros(3), root, "s")


def timed(spark, path, times, per_block=50):
    schema = record_schema([("Counter", "Int32")])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_block)
    try:
        df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], schema)
        rec.write_recordings(df.coalesce(1), path, "Timed")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    return df


def test_a_time_range_decodes_only_its_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rec, "SECTION_BYTES", 1_500)
    monkeypatch.setattr(rec, "BLOCK_ROWS", 20)
    path = str(tmp_path / "rec")
    timed(spark, path, [float(i) for i in range(1_000)])
    assert rec.sections(spark, path).where("type = 'Data'").count() > 5
    decoded = []
    plain = rec.decode
    monkeypatch.setattr(rec, "decode", lambda block, s, wanted: decoded.append(len(block) // s.dtype.itemsize) or plain(block, s, wanted))
    file = next((tmp_path / "rec").glob("*.rec"))
    schema = record_schema([("Counter", "Int32")])
    arrow = rec.pa.schema([("TimeStamp", rec.pa.float64()), ("Counter", rec.pa.int32())])
    whole = rec.ByteRange(str(file), file.stat().st_size, 0, file.stat().st_size)

    def read(*conditions):
        decoded.clear()
        batches = rec.read_range(rec.pafs.LocalFileSystem(), whole, schema, arrow, list(conditions))
        return {x for b in batches for x in b.column(1).to_pylist()}, sum(decoded)

    time = ("TimeStamp",)
    assert read() == (set(range(1_000)), 1_000)
    got, n = read(rec.GreaterThanOrEqual(time, 420.0), rec.LessThanOrEqual(time, 460.0))
    assert n == 100 and set(range(420, 461)) <= got
    assert read(rec.GreaterThan(time, 999.0)) == (set(), 0) and read(rec.LessThan(time, 0.0)) == (set(), 0)
    assert read(rec.EqualTo(time, 50.0)) == (set(range(50, 100)), 50)
    assert read(rec.In(time, (3.0, 777.0)))[1] == 100


@pytest.mark.parametrize("split", [97, 1 << 20])
def test_conditions_on_time_give_the_same_records(spark, tmp_path, split):
    times = [float(i % 313) for i in range(600)] + [float("nan")] * 3 + [float("inf"), -0.0, float("-inf")] + [float("nan")] * 60
    path = str(tmp_path / "rec")
    df = timed(spark, path, times)
    back = rec.read_recordings(spark, path, splitBytes=split).select(df.columns)
    ways = (
        "TimeStamp between 100 and 120", "TimeStamp > 311", "TimeStamp >= double('inf')", "TimeStamp < 0", "TimeStamp <= 0", "TimeStamp = 0", "TimeStamp > double('inf')",
        "TimeStamp = double('nan')", "TimeStamp in (7, 9, 5000)", "TimeStamp <=> 7", "not TimeStamp < 300", "TimeStamp > 300 and Counter < 320", "120 > TimeStamp",
    )
    for way in ways:
        assert same(back.where(way), df.where(way)), way
    assert rec.read_recordings(spark, path, fields="Counter").where("Counter < 5").count() == 5


def test_files_without_a_whole_index_are_read_whole(spark, tmp_path):
    path = tmp_path / "rec"
    df = timed(spark, str(path), [float(i) for i in range(200)])
    file = next(path.glob("*.rec"))
    whole = file.read_bytes()
    for data, n in ((whole + whole, 22), (whole[: whole.rindex(b"\x43\x52\x03\x00")], 11), (whole, 11)):
        file.write_bytes(data)
        assert rec.read_recordings(spark, str(path)).where("TimeStamp between 60 and 70").count() == n
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert spark.read.format("records").load(f"file://{path}").where("TimeStamp < 10").count() == 10
    assert df.count() == 200


def test_a_repeated_micro_batch_is_recorded_once(spark, tmp_path):
    schema = record_schema([("v", "Int64")])
    sm.register_stream(spark, str(tmp_path / "root"), "s", schema)

    def publish(lo, hi):
        sm.publish(spark.range(lo, hi, 1, 2).select(F.lit(1.0).alias("TimeStamp"), F.col("id").alias("v")), str(tmp_path / "root"), "s")

    def record(name="ckpt"):
        sdf = sm.read_stream(spark, str(tmp_path / "root"), "s", max_files=1)
        query = rec.write_recordings_live(sdf, str(tmp_path / "rec"), str(tmp_path / name), "S", available_now=True)
        query.awaitTermination()

    publish(0, 10)
    record()
    last = max(int(p.name) for p in (tmp_path / "ckpt" / "commits").iterdir() if p.name.isdigit())
    for gone in (f"{last}", f".{last}.crc"):  # as if the driver had gone before Spark noted the micro-batch
        (tmp_path / "ckpt" / "commits" / gone).unlink(missing_ok=True)
    publish(10, 20)
    record()
    back = lambda: sorted(r.v for r in rec.read_recordings(spark, str(tmp_path / "rec")).collect())
    assert back() == list(range(20))
    assert all(p.name.endswith(".rec") for p in (tmp_path / "rec").iterdir())
    record("other")  # another query adds its own files
    assert back() == sorted([*range(20)] * 2)
    assert rec.read_recordings(spark, str(tmp_path / "rec")).where("TimeStamp > 1").count() == 0


HANDOVER = """
import sys
from pyspark.sql import SparkSession, functions as F
from recspark.sources import exchange as ex
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.maxResultSize", "1m")
    .config("spark.sql.shuffle.partitions", "40").config("spark.sql.adaptive.coalescePartitions.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
df = spark.range(400_000).select((F.col("id") * 7919 % 400_000).cast("double").alias("TimeStamp"), F.col("id").alias("part"), F.rand(1).alias("row"))
try:
    ex.to_arrow(df, None)
    print("no limit")
except Exception as e:
    print("maxResultSize" in str(e))
times, most = [], 0
for b in ex.arrow_batches(df):
    assert b.schema.names == ["TimeStamp", "part", "row"]
    times += b.column(0).to_pylist()
    most = max(most, b.num_rows)
print(times == [float(i) for i in range(400_000)], most < 40_000)
"""


def test_a_recording_larger_than_the_driver_takes_at_once(tmp_path):
    root = str(paths.__file__).rsplit("/", 3)[0]
    ran = subprocess.run([sys.executable, "-c", HANDOVER, str(tmp_path)], cwd=root, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert ran.stdout.split() == ["True", "True", "True"], ran.stdout + ran.stderr[-2000:]


def test_arrow_batches_of_little(spark):
    df = spark.createDataFrame([(2.0, 1, 5.0), (1.0, 2, 6.0)], ENGINE)
    assert [r["SensorValue"] for b in ex.arrow_batches(df) for r in b.to_pylist()] == [2, 1]
    assert list(ex.arrow_batches(df.where("SensorValue > 9"))) == []
