"""The package's queries on the benchmark tables, seen as record streams.

``events`` is a recording: ``TimeStamp`` is its time as epoch seconds, ``event_type`` or
``user_id`` tells streams apart, ``status`` is a word with named bits.  ``embeddings`` has an
array field and ``lineitem`` is a wide numeric record.  Every query reads whole tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fields as fn
from ..operators import ordering as od, stats as st, status as sx
from ..schema import field, record_schema
from ..sources import exchange as ex, recordings as rec, streams as sm
from ..sources.paths import open_fs, readable
from ..streaming import consumers, live
from ..workspace import work_dir
from .ranges import local_seconds

ORDER = ["TimeStamp", "event_id"]
#: The same order by the stored column, whose bounds reach the scan; and bounds as the table stores them.
STORED_ORDER = ["ts", "event_id"]
FROM, UPTO = "2024-01-03 16:40:00", "2024-01-22 05:06:40"
# Fixed fixture values: the bit layout of ``status_bits``.
STATUS_BITS = {"tx": 0, "rx": 1, "errFlag": 6}

EVENT_RECORD = record_schema(
    [
        ("event_id", "Int64"),
        ("user_id", "Int64"),
        ("event_type", "Char", 16),
        ("value", "Double"),
        ("status", "UInt8", ["tx", "rx", "4", "errFlag"]),
    ]
)
VECTOR_RECORD = record_schema([("vec_id", "Int64"), ("embedding", "Float", 64), ("label", "Int32")])
LINE_RECORD = record_schema(
    [
        ("l_orderkey", "Int64"),
        ("l_linenumber", "Int32"),
        ("l_quantity", "Double"),
        ("l_extendedprice", "Double"),
        ("l_discount", "Double"),
        ("l_tax", "Double"),
    ]
)


def _epoch(name: str):
    return local_seconds(F.col(name).cast("timestamp_ntz")).cast("double")


def _stored(time: str):
    return F.lit(time).cast("timestamp_ntz")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    df = _table(spark, sf, "events").select(
        _epoch("ts").alias("TimeStamp"),
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("event_id").bitwiseAND(F.lit(255)).cast("short").alias("status"),
    )
    return sm.with_fields(df, EVENT_RECORD)


def stored_events(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` with the time as stored, too."""
    df = _table(spark, sf, "events")
    return sm.with_fields(
        df.select(
            _epoch("ts").alias("TimeStamp"), "event_id", "user_id", "event_type", "value",
            F.col("event_id").bitwiseAND(F.lit(255)).cast("short").alias("status"), "ts",
        ),
        EVENT_RECORD,
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    df = _table(spark, sf, "embeddings").select(F.col("vec_id").cast("double").alias("TimeStamp"), "vec_id", "embedding", "label")
    return sm.with_fields(df, VECTOR_RECORD)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    df = _table(spark, sf, "lineitem").select(_epoch("l_shipdate").alias("TimeStamp"), *LINE_RECORD.names[1:])
    return sm.with_fields(df, LINE_RECORD)


def _r(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


def _mean():
    """A mean of hundredths can lie exactly between two rounded values; tip it over."""
    return F.round(F.col("mean") + 1e-9, 6).alias("mean")


# ---- order -------------------------------------------------------------------------------


def record_positions(spark, sf):
    return od.with_seq(events(spark, sf).select("TimeStamp", "event_id"), ORDER).select("event_id", "seq")


def stream_positions(spark, sf):
    df = events(spark, sf).select("TimeStamp", "event_id", "event_type")
    return od.with_seq(df, ORDER, "event_type").select("event_id", "event_type", "seq")


def split_stream_positions(spark, sf):
    """The plan for streams too large for one task, here for every stream."""
    df = events(spark, sf).select("TimeStamp", "event_id", "event_type")
    return od.with_seq(df, ORDER, "event_type", max_group_rows=0).select("event_id", "event_type", "seq")


def text_positions(spark, sf):
    """Positions in the order of a text, which many events share, and then of the id."""
    df = _table(spark, sf, "events").select("event_id", "props")
    return od.with_seq(df, ["props", "event_id"], n_ranges=32)


def record_batches(spark, sf):
    return od.batches(events(spark, sf).select("TimeStamp", "event_id"), 1000, ORDER).select("event_id", "batch")


def latest_global(spark, sf):
    return od.latest(stored_events(spark, sf), 2000, STORED_ORDER).select("event_id", "TimeStamp", "value", "seq")


def latest_per_stream(spark, sf):
    return od.latest(events(spark, sf), 10, ORDER, "user_id").select("user_id", "event_id", "value", "seq")


def latest_split_stream(spark, sf):
    df = od.latest(events(spark, sf), 100, ORDER, "event_type", max_group_rows=0)
    return df.select("event_type", "event_id", "value", "seq")


def slice_records(spark, sf):
    return od.slice_records(stored_events(spark, sf), 1234, 777, STORED_ORDER).select("event_id", "value", "seq")


def read_after(spark, sf):
    return od.read_after(stored_events(spark, sf), 2500, order_by=STORED_ORDER).select("event_id", "value", "seq")


def read_after_per_stream(spark, sf):
    df = od.read_after(events(spark, sf), 5, 20, ORDER, "user_id")
    return df.select("user_id", "event_id", "seq")


def head_records(spark, sf):
    return od.head(events(spark, sf), 100, ORDER).select("event_id", "TimeStamp", "value")


def concat_records(spark, sf):
    ev, li = events(spark, sf), lines(spark, sf)
    return od.concat(
        [
            ev.select("TimeStamp", F.col("event_id").alias("id"), F.col("value").alias("y")),
            li.select("TimeStamp", F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("y")),
        ]
    )


# ---- fields ------------------------------------------------------------------------------


def select_fields(spark, sf):
    return fn.select_fields(events(spark, sf), ["TimeStamp", "value"])


def numeric_value(spark, sf):
    df = events(spark, sf)
    return df.select(
        "event_id",
        fn.value(df, "event_id").alias("id_double"),
        fn.value(df, "value", as_type="Int32").alias("value_int32"),
        F.coalesce(fn.value(df, "event_id", as_type="UInt8"), F.lit(-1).cast("short")).alias("id_uint8"),
        fn.value(df, "status", as_type="Int16").alias("status_int16"),
    )


def set_value(spark, sf):
    df = fn.set_value(events(spark, sf), "value", F.col("value") * 2.0 + 1.0)
    return fn.set_value(df, "user_id", 7).select("event_id", "user_id", "value")


def set_array_value(spark, sf):
    df = fn.set_value(vectors(spark, sf), "embedding", F.lit(0.5), index=3)
    return df.select("vec_id", F.col("embedding")[2].alias("e2"), F.col("embedding")[3].alias("e3"))


def clear_records(spark, sf):
    return fn.clear(events(spark, sf))


def named_bits(spark, sf):
    df = events(spark, sf)
    return df.select(
        "event_id", fn.bit(df, "tx").alias("tx"), fn.bit(df, "errFlag").alias("err"), fn.bit_value(df, "rx").alias("rx_value")
    )


def expand_bits(spark, sf):
    return fn.expand_bits(events(spark, sf)).select("event_id", "status", "tx", "rx", "errFlag")


def set_bit(spark, sf):
    df = fn.set_bit(events(spark, sf), "errFlag", True)
    df = fn.set_bit(df, "tx", F.lit(0.0))
    return fn.set_bit(df, "rx", F.col("value") > 50.0).select("event_id", "status")


def array_element(spark, sf):
    df = vectors(spark, sf)
    return df.select("vec_id", fn.value(df, "embedding", 0).alias("first"), fn.element(df, "embedding", 63).alias("last"))


def explode_elements(spark, sf):
    return fn.explode_elements(vectors(spark, sf), "embedding", ["vec_id"])


def channels(spark, sf):
    return fn.channels(events(spark, sf), keep=["event_id"])


def array_channels(spark, sf):
    return fn.channels(vectors(spark, sf), keep=["vec_id"], skip=["TimeStamp", "vec_id"])


def range_filter(spark, sf):
    return fn.in_range(stored_events(spark, sf), _stored(FROM), _stored(UPTO), "ts").select("event_id", "TimeStamp", "value")


# ---- statistics --------------------------------------------------------------------------


def batch_stats(spark, sf):
    out = st.batch_stats(events(spark, sf), 1000, "value", ORDER)
    return out.select("batch", "count", "total", _r("mean"), _r("std"))


def batch_stats_per_stream(spark, sf):
    out = st.batch_stats(events(spark, sf), 250, "value", ORDER, "event_type")
    return out.select("event_type", "batch", "count", "total", _r("mean"), _r("std"))


def _stats(df: DataFrame, *by: str) -> DataFrame:
    return df.select(*by, "field", "count", _r("mean", 4), _r("min"), _r("max"))


def field_stats(spark, sf):
    return _stats(st.field_stats(lines(spark, sf)))


def field_stats_per_stream(spark, sf):
    return _stats(st.field_stats(events(spark, sf), "event_type"), "event_type")


def array_stats(spark, sf):
    return _stats(st.field_stats(vectors(spark, sf), fields=["embedding", "label"]))


def describe_fields(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = st.describe(lines(spark, sf), names)
    return out.select("field", "count", *[_r(c, 4) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def describe_value(spark, sf):
    out = st.describe(events(spark, sf), ["value"])
    return out.select("field", "count", *[_r(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def _running(df: DataFrame) -> DataFrame:
    return df.select("event_id", "count", _mean(), "min", "max")


def running_stats(spark, sf):
    return _running(st.running_stats(events(spark, sf), "value", ORDER, "user_id"))


def running_stats_one_stream(spark, sf):
    return _running(st.running_stats(events(spark, sf), "value", ORDER))


def running_stats_split_stream(spark, sf):
    return _running(st.running_stats(events(spark, sf), "value", ORDER, "event_type", max_group_rows=0))


def running_summary(spark, sf):
    out = st.running_summary(events(spark, sf), "value", "event_type")
    return out.select("event_type", "count", _mean(), "min", "max")


def rate_per_hour(spark, sf):
    return st.rate(events(spark, sf), 3600).select("TimeStamp", "count", _r("rate", 9))


def rate_tenth(spark, sf):
    """Intervals that binary fractions cannot hold: tenths of a second, over times in tenths of a second."""
    df = events(spark, sf).withColumn("TimeStamp", F.col("event_id") / 10.0)
    return st.rate(df, 0.1).select(F.round(F.col("TimeStamp") * 10).cast("long").alias("tenth"), "count")


def rate_per_stream(spark, sf):
    return st.rate(events(spark, sf), 86400, "event_type").select("event_type", "TimeStamp", "count", _r("rate", 9))


def visible_range(spark, sf):
    out = st.visible_range(stored_events(spark, sf), _stored(FROM), _stored(UPTO), "ts", skip=["ts"])
    return out.select("channel", _r("y_min", 3), _r("y_max", 3))


def visible_array_range(spark, sf):
    out = st.visible_range(vectors(spark, sf), 10.0, 1e9, skip=["TimeStamp", "vec_id"])
    return out.select("channel", _r("y_min", 4), _r("y_max", 4))


def _status(spark, sf):
    return sx.stream_status(events(spark, sf), 1500, "event_type")


def stream_status(spark, sf):
    return _status(spark, sf)


def _cursors(spark, sf):
    """Each user as a consumer of each stream; every tenth one is passive."""
    read = F.when(F.col("user_id") % 10 != 0, F.count(F.lit(1)))
    return events(spark, sf).groupBy("event_type", F.col("user_id")).agg(read.alias("cursor"))


def consumer_lag(spark, sf):
    out = sx.consumer_lag(_status(spark, sf), _cursors(spark, sf), "event_type")
    return out.select("event_type", "user_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("cursor", "lag")])


def write_space(spark, sf):
    return sx.write_space(_status(spark, sf), _cursors(spark, sf), "event_type")


def write_space_all_streams(spark, sf):
    """All registered streams, one of them without records and one without a name."""
    root = work_dir(spark, "streams")
    sm.register_stream(spark, root, "silent", EVENT_RECORD)
    df = events(spark, sf)
    named = df.select(F.when(F.col("event_type") != "click", F.col("event_type")).alias("stream"))
    status = sx.stream_status(named, 1500, "stream", sm.catalog(spark, root).select("stream").distinct())
    cursors = named.groupBy("stream").agg(F.expr("count(1) div 2").alias("cursor"))
    return sx.write_space(status, cursors, "stream").select(F.coalesce("stream", F.lit("-")).alias("stream"), "max_lag", "free")


# ---- sources and sinks -------------------------------------------------------------------


def _published(spark, sf, parts: int = 4) -> str:
    """``events`` as a named stream of several files in time order; returns the root."""
    root = work_dir(spark, "streams")
    sm.register_stream(spark, root, "events", EVENT_RECORD)
    sm.publish(events(spark, sf).repartitionByRange(parts, "TimeStamp"), root, "events")
    return root


def publish_roundtrip(spark, sf):
    root = _published(spark, sf)
    return sm.read_table(spark, root, "events")


def _hourly(spark, sf) -> str:
    """``events`` with times cut to the hour, so that many are equal, published in four parts that each go through all hours; returns the root."""
    root = work_dir(spark, "streams")
    sm.register_stream(spark, root, "events", EVENT_RECORD)
    rows = events(spark, sf).withColumn("TimeStamp", F.floor(F.col("TimeStamp") / 3600) * 3600.0)
    for part in range(4):
        sm.publish(rows.where(F.pmod("event_id", F.lit(4)) == part).orderBy("event_id"), root, "events")
    return root


def arrival_positions(spark, sf):
    """Every record with the position at which it came into the stream."""
    return sm.read_arrivals(spark, _hourly(spark, sf), "events").select("event_id", "TimeStamp", "position")


def slice_published(spark, sf):
    """A quarter of the records by arrival, from the first third on."""
    root = _hourly(spark, sf)
    end = sm.end_position(spark, root, "events")
    return sm.slice_published(spark, root, "events", end // 3, end // 4).select("event_id", "value", "position")


def published_between(spark, sf):
    """The records of some days by time, equal times in the order of arrival."""
    root = _hourly(spark, sf)
    rows = sm.published_between(spark, root, "events", 1_704_300_000.0, 1_705_900_000.0)
    return od.with_seq(rows, ["TimeStamp", "position"]).select("event_id", "TimeStamp", "position", "seq")


def catalog_fields(spark, sf):
    """The registered streams' fields, with the number of records each stream holds."""
    root = _published(spark, sf)
    sm.register_stream(spark, root, "vectors", VECTOR_RECORD)
    sm.publish(vectors(spark, sf), root, "vectors")
    written = od.concat(
        [sm.read_table(spark, root, n).groupBy(F.lit(n).alias("stream")).agg(F.count(F.lit(1)).alias("records")) for n in ("events", "vectors")]
    )
    fields = sm.catalog(spark, root).select("stream", "pos", "field", "src_type", "count", F.size("bits").alias("n_bits"))
    return fields.join(written, "stream")


def binary_roundtrip(spark, sf):
    path = work_dir(spark, "recording")
    rec.write_recordings(events(spark, sf), path, "Events", align=True)
    return rec.read_recordings(spark, path).drop("_file", "_pos").withColumnRenamed("_alias", "alias")


def array_roundtrip(spark, sf):
    path = work_dir(spark, "recording")
    rec.write_recordings(vectors(spark, sf), path, "Vectors")
    back = rec.read_recordings(spark, path, fields="vec_id,embedding")
    return fn.explode_elements(back, "embedding", ["vec_id"])


def sections_inventory(spark, sf):
    path = work_dir(spark, "recording")
    rec.write_recordings(events(spark, sf).repartition(3), path, "Events")
    rec.write_recordings(vectors(spark, sf).repartition(2), path, "Vectors")
    return (
        rec.sections(spark, path)
        .groupBy("name", "type")
        .agg(
            F.max("n_fields").alias("n_fields"),
            F.max("rec_size").alias("rec_size"),
            F.sum("n_records").alias("n_records"),
            F.sum(F.when(F.col("type") == "Data", F.col("body_length")).otherwise(0)).alias("data_bytes"),
        )
    )


def recording_range(spark, sf):
    """The records of some days from a recording in order of time; blocks of other days are passed over."""
    path = work_dir(spark, "recording")
    rec.write_recordings(events(spark, sf).repartitionByRange(8, "TimeStamp").sortWithinPartitions(*ORDER), path, "Events")
    back = rec.read_recordings(spark, path)
    return fn.in_range(back, 1_704_300_000.0, 1_705_900_000.0).select("event_id", "TimeStamp", "value")


def csv_roundtrip(spark, sf):
    path = work_dir(spark, "csv")
    ex.write_csv(events(spark, sf), path)
    return ex.read_csv(spark, path, EVENT_RECORD)


def csv_text_roundtrip(spark, sf):
    """Text with blanks at both ends, commas and quotes through CSV."""
    path = work_dir(spark, "csv")
    text = F.concat(F.lit('  a,"'), F.col("event_type"), F.lit("' \\ ,\" "))
    ex.write_csv(events(spark, sf).withColumn("event_type", text), path)
    return ex.read_csv(spark, path, EVENT_RECORD).select("event_id", "event_type")


def array_csv_roundtrip(spark, sf):
    """Every array element through CSV, and whether it is the same to six decimals."""
    path = work_dir(spark, "csv")
    ex.write_csv(vectors(spark, sf), path)
    back = fn.explode_elements(ex.read_csv(spark, path, VECTOR_RECORD), "embedding", ["vec_id"])
    before = fn.explode_elements(vectors(spark, sf), "embedding", ["vec_id"]).withColumnRenamed("y", "was")
    same = F.abs(F.col("y").cast("double") - F.col("was").cast("double")) <= 6e-7
    return before.join(back, ["vec_id", "index"], "left").select("vec_id", "index", F.coalesce(same, F.lit(False)).alias("same"))


def record_producer(spark, sf):
    """A per-record producer over the table's own indexes; every third index makes none."""
    schema = record_schema([("event_id", "Int64"), ("half", "Double")])
    step = ex.each_record(lambda i: None if i % 3 == 0 else {"TimeStamp": float(i), "event_id": i, "half": i / 2})
    return ex.produce(events(spark, sf).select("event_id"), schema, step)


def whole_recording(spark, sf):
    """A whole recording as Arrow batches, each validated in the task that decodes it."""
    path = work_dir(spark, "recording")
    rec.write_recordings(events(spark, sf), path, "Events")

    def whole(batches):
        for batch in batches:
            batch.validate(full=True)
            yield batch

    back = rec.read_recordings(spark, path).select("event_id", "value")
    return back.mapInArrow(whole, back.schema)


def snapshot_frame(spark, sf):
    pdf = ex.to_frame(events(spark, sf), 2000, ORDER)
    return spark.createDataFrame(pdf[["event_id", "value"]])


# ---- live streams ------------------------------------------------------------------------


def _live(spark, sf) -> DataFrame:
    return sm.read_stream(spark, _published(spark, sf), "events", max_files=1)


def live_consumer_lag(spark, sf):
    """How far three consumers are behind: one that took the first half, one that took all, one that only looks on.

    What the first two took they published into streams of their own, which are counted beside their cursors; -1 stands for null.
    """
    root = work_dir(spark, "streams")
    for name in ("events", "slow", "quick"):
        sm.register_stream(spark, root, name, EVENT_RECORD)
    checkpoints = {n: work_dir(spark, "checkpoint") for n in ("slow", "quick")}

    def take(name: str) -> None:
        copy = lambda rows, i: sm.publish(rows.drop("position"), root, name, batch=i)
        live.drain(consumers.consume(spark, root, "events", name, copy, checkpoints[name], max_publishes=1, available_now=True))

    consumers.watch(spark, root, "events", "onlooker")
    for part in range(4):
        sm.publish(events(spark, sf).where(F.pmod("event_id", F.lit(4)) == part), root, "events")
        if part == 1:
            take("slow")
            take("quick")
    take("quick")
    copies = consumers.ends(spark, root).select(F.col("stream").alias("consumer"), F.col("total_written").alias("copied"))
    rows = consumers.live_lag(spark, root).join(copies, "consumer", "left")
    return rows.select("stream", "consumer", *[F.coalesce(c, F.lit(-1).cast("long")).alias(c) for c in ("cursor", "lag", "copied")])


def stream_records(spark, sf):
    """A live read, published into a second stream batch by batch."""
    out, ckpt = work_dir(spark, "live"), work_dir(spark, "checkpoint")
    sm.register_stream(spark, out, "copy", EVENT_RECORD)
    query = live.for_each_batch(_live(spark, sf), lambda b, i: sm.publish(b, out, "copy", batch=i), ckpt, available_now=True)
    live.drain(query)
    return sm.read_table(spark, out, "copy")


def record_to_both(spark, sf):
    out, ckpt = work_dir(spark, "both"), work_dir(spark, "checkpoint")
    sinks = [live.binary_sink(f"{out}/bin", "Events"), live.csv_sink(f"{out}/csv")]
    live.drain(live.record_to(_live(spark, sf), sinks, ckpt, available_now=True))
    binary = rec.read_recordings(spark, f"{out}/bin").select(F.lit("binary").alias("sink"), "event_id", "value", "status")
    csv = ex.read_csv(spark, f"{out}/csv/*", EVENT_RECORD).select(F.lit("csv").alias("sink"), "event_id", "value", "status")
    return od.concat([binary, csv])


def stream_to_recording(spark, sf):
    """A live stream recorded micro-batch by micro-batch, stopped and started again half way."""
    path, ckpt = work_dir(spark, "recording"), work_dir(spark, "checkpoint")
    root = work_dir(spark, "streams")
    sm.register_stream(spark, root, "events", EVENT_RECORD)
    for half in range(2):
        sm.publish(events(spark, sf).where(F.pmod("event_id", F.lit(2)) == half).repartition(2), root, "events")
        sdf = sm.read_stream(spark, root, "events", max_files=1)
        live.drain(rec.write_recordings_live(sdf, path, ckpt, "Events", available_now=True))
    return rec.read_recordings(spark, path).drop("_file", "_pos").withColumnRenamed("_alias", "alias")


def stream_recordings(spark, sf):
    """Recordings read live, in small byte ranges."""
    path, out, ckpt = work_dir(spark, "recording"), work_dir(spark, "live"), work_dir(spark, "checkpoint")
    rec.write_recordings(events(spark, sf).repartition(3), path, "Events")
    sdf = rec.stream_recordings(spark, path, split_bytes=100_000, max_files=2).drop("_file", "_pos", "_alias")
    query = live.for_each_batch(sdf, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), ckpt, available_now=True)
    live.drain(query)
    return spark.read.parquet(out).drop("batch")


def stream_followed(spark, sf):
    """A recording that is followed while it is written, by a reader that is stopped and started again after each part."""
    path, out, ckpt = work_dir(spark, "recording"), work_dir(spark, "live"), work_dir(spark, "checkpoint")
    for part in range(3):
        rec.write_recordings(events(spark, sf).where(F.pmod("event_id", F.lit(3)) == part).repartition(2), path, "Events")
        sdf = rec.follow_recordings(spark, path, splitBytes=100_000).drop("_file", "_pos", "_alias")
        live.drain(live.for_each_batch(sdf, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), ckpt, available_now=True))
    return spark.read.parquet(out).withColumnRenamed("batch", "part")


def stream_running_stats(spark, sf):
    out, ckpt = work_dir(spark, "live"), work_dir(spark, "checkpoint")
    summary = st.running_summary(_live(spark, sf), "value", "event_type")
    live.drain(live.keep_result(summary, out, ckpt, "event_type", state_partitions=4, available_now=True))  # five streams
    return live.read_result(spark, out).select("event_type", "count", _mean(), "min", "max")


def stream_rate(spark, sf):
    """Files may be read in any order, so a record may be late by the time that the whole table spans."""
    out, ckpt = work_dir(spark, "live"), work_dir(spark, "checkpoint")
    span = events(spark, sf).agg(F.max("TimeStamp") - F.min("TimeStamp")).first()[0] or 0.0
    hourly = live.live_rate(_live(spark, sf), 3600, delay=f"{int(span) + 2} seconds")
    live.drain(live.keep_result(hourly, out, ckpt, "TimeStamp", state_partitions=4, available_now=True))  # one row per hour
    return live.read_result(spark, out).select("TimeStamp", "count", _r("rate", 9))


def stream_latest(spark, sf):
    out, ckpt = work_dir(spark, "live"), work_dir(spark, "checkpoint")
    live.drain(live.latest_stream(_live(spark, sf), 10, out, ckpt, "user_id", ORDER, available_now=True))
    return live.read_result(spark, out).select("user_id", "event_id", "value", "seq")


def _in_turn(spark, sf, backwards: bool) -> str:
    """``events`` published in four spans of time, the first or the last one first; returns the root."""
    root = work_dir(spark, "streams")
    sm.register_stream(spark, root, "events", EVENT_RECORD)
    df = events(spark, sf)
    lo, hi = df.agg(F.min("TimeStamp"), F.max("TimeStamp")).first()
    step = (hi - lo) / 4
    spans = F.least(F.floor((F.col("TimeStamp") - lo) / step), F.lit(3))
    for i in sorted(range(4), reverse=backwards):
        sm.publish(df.where(spans == i), root, "events")
    if backwards:  # a record long after all others, which tells that no more come
        end = df.limit(1).withColumns({"TimeStamp": F.lit(2 * hi - lo + 60), "user_id": F.lit(-1).cast("long")})
        sm.publish(end, root, "events")
    return root


def stream_running_records(spark, sf):
    """Every record with the statistics of its stream up to it, though the spans of time are read last one first."""
    root, out, ckpt = _in_turn(spark, sf, True), work_dir(spark, "live"), work_dir(spark, "checkpoint")
    lo, hi = events(spark, sf).agg(F.min("TimeStamp"), F.max("TimeStamp")).first()
    sdf = sm.read_stream(spark, root, "events", max_files=4)
    live.drain(live.running_stream(sdf, "value", out, ckpt, f"{int(hi - lo) + 1} seconds", "user_id", ORDER, available_now=True))
    return _running(spark.read.parquet(f"{out}/*"))


def stream_record_batches(spark, sf):
    """Statistics of batches of exactly 1,000 records, the last one excepted, whatever the files hold."""
    root, out, ckpt = _in_turn(spark, sf, False), work_dir(spark, "live"), work_dir(spark, "checkpoint")

    def stats(batch: DataFrame) -> DataFrame:
        return batch.groupBy("batch").agg(
            F.count(F.lit(1)).alias("count"), (F.max("seq") + 1).alias("total"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
        )

    sdf = sm.read_stream(spark, root, "events", max_files=4)
    live.drain(live.for_each_n(sdf, 1_000, live.store_by(out, "batch", stats), ckpt, ORDER, partial=True, available_now=True))
    return live.read_result(spark, out).select("batch", "count", "total", _r("mean"), _r("std"))


def stream_batch_stats(spark, sf):
    """Mean and deviation of each micro-batch; a batch here is one published file."""
    out, ckpt = work_dir(spark, "live"), work_dir(spark, "checkpoint")

    def per_batch(batch: DataFrame, i: int) -> None:
        one = batch.agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.stddev_pop("value").alias("d"))
        one.write.mode("overwrite").parquet(f"{out}/batch={i}")

    live.drain(live.for_each_batch(_live(spark, sf), per_batch, ckpt, available_now=True))
    n = F.col("n")
    # the batches' moments, put together again
    return spark.read.parquet(out).agg(
        F.sum(n).alias("count"),
        F.round(F.sum(n * F.col("m")) / F.sum(n), 6).alias("mean"),
        F.round(
            F.sqrt(F.sum(n * (F.col("d") ** 2 + F.col("m") ** 2)) / F.sum(n) - (F.sum(n * F.col("m")) / F.sum(n)) ** 2), 4
        ).alias("std"),
    )


def stream_each_record(spark, sf):
    """User code per record that writes one line each; one file per partition and epoch."""
    out, ckpt = readable(spark, work_dir(spark, "live")), work_dir(spark, "checkpoint")
    state = {}

    def on_start(partition, epoch):
        fs, root = open_fs(out)
        fs.create_dir(root, recursive=True)
        state["file"] = fs.open_output_stream(f"{root}/e{epoch}-p{partition}.json")

    def process(row):
        line = json.dumps({"event_id": row["event_id"], "value": row["value"]})
        state["file"].write(line.encode() + b"\n")

    live.drain(
        live.for_each_record(_live(spark, sf), process, ckpt, on_start, lambda err: state.pop("file").close(), available_now=True)
    )
    return spark.read.schema("event_id long, value double").json(out)


def stream_progress(spark, sf):
    """Rows reported to a progress callback, over a whole run; a failing callback changes nothing."""
    ckpt, seen = work_dir(spark, "checkpoint"), []

    def fails(progress):
        raise RuntimeError("callbacks may fail")

    off = [live.on_progress(spark, lambda p: seen.append(p.numInputRows)), live.on_progress(spark, fails)]
    try:
        query = live.for_each_batch(_live(spark, sf), lambda b, i: b.write.format("noop").mode("overwrite").save(), ckpt, available_now=True)
        live.drain(query)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        for stop in off:
            stop()
    return spark.createDataFrame([(int(sum(seen)),)], "records long")


QUERIES = {
    f.__name__: f
    for f in (
        batch_stats, batch_stats_per_stream, field_stats, field_stats_per_stream, array_stats, describe_fields,
        describe_value, running_stats, running_stats_one_stream, running_stats_split_stream, running_summary,
        rate_per_hour, rate_tenth, rate_per_stream, visible_range, visible_array_range, stream_status, consumer_lag, write_space,
        write_space_all_streams,
        record_positions, text_positions, stream_positions, split_stream_positions, record_batches, latest_global, latest_per_stream,
        latest_split_stream, slice_records, read_after, read_after_per_stream, head_records, concat_records,
        select_fields, numeric_value, set_value, set_array_value, clear_records, named_bits, expand_bits, set_bit,
        array_element, explode_elements, channels, array_channels, range_filter,
        catalog_fields, publish_roundtrip, arrival_positions, slice_published, published_between, binary_roundtrip, array_roundtrip, sections_inventory, recording_range, csv_roundtrip,
        csv_text_roundtrip, array_csv_roundtrip, record_producer, whole_recording, snapshot_frame,
        live_consumer_lag, stream_records, record_to_both, stream_to_recording, stream_recordings, stream_followed, stream_running_stats, stream_rate, stream_latest,
        stream_running_records, stream_record_batches, stream_batch_stats, stream_each_record, stream_progress,
    )
}
