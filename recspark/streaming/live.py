"""Live streams: recording, latest records, statistics, user code, progress, stopping.

Each query takes its own checkpoint folder.  Of results that a query keeps up to date, a micro-batch writes
what it changed as a version of its own, so a retried micro-batch overwrites its own version.
"""

from __future__ import annotations

import json
import logging
import re
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.ordering import as_list
from ..operators.stats import interval_micros, micros
from ..plans.ranges import col
from ..schema import TIME_FIELD
from ..sources.exchange import write_csv
from ..sources.paths import entries, exists, remove, write_once
from ..sources.recordings import write_recordings
from .keyed import latest_records, record_batches, running_records, state_settings

log = logging.getLogger(__name__)

BatchFn = Callable[[DataFrame, int], None]


def _start(writer, checkpoint: str, available_now: bool, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def for_each_batch(
    sdf: DataFrame,
    fn: BatchFn,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``fn(batch, id)`` on every micro-batch; a retried batch comes with the same id.

    With ``available_now`` the query ends by itself when it has read what is there; otherwise a
    micro-batch starts every ``interval``, or as soon as the last one is done.
    """
    return _start(sdf.writeStream.foreachBatch(fn).outputMode(mode), checkpoint, available_now, interval)


class _RecordHandler:
    def __init__(self, process, on_start, on_stop):
        self.process, self.on_start, self.on_stop = process, on_start, on_stop

    def open(self, partition_id, epoch_id):
        if self.on_start:
            self.on_start(partition_id, epoch_id)
        return True

    def close(self, error):
        if self.on_stop:
            self.on_stop(error)


def for_each_record(
    sdf: DataFrame,
    process: Callable[[Row], None],
    checkpoint: str,
    on_start: Callable[[int, int], None] | None = None,
    on_stop: Callable[[Exception | None], None] | None = None,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Run ``process(row)`` on every record, with hooks around each partition of a micro-batch."""
    handler = _RecordHandler(process, on_start, on_stop)
    return _start(sdf.writeStream.foreach(handler), checkpoint, available_now, interval)


def binary_sink(path: str, alias: str = "") -> BatchFn:
    return lambda batch, i: write_recordings(batch, f"{path}/batch-{i:012d}", alias, mode="overwrite")


def csv_sink(path: str) -> BatchFn:
    return lambda batch, i: write_csv(batch, f"{path}/batch-{i:012d}", mode="overwrite")


def record_to(sdf: DataFrame, sinks: Sequence[BatchFn], checkpoint: str, **trigger) -> StreamingQuery:
    """Send every record of a stream to all sinks.

    The input of a micro-batch is computed once.  Sinks name their output by batch id, so a
    retry replaces what the failed try left.
    """

    def run(batch: DataFrame, i: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, i)
        finally:
            batch.unpersist()

    return for_each_batch(sdf, run, checkpoint, **trigger)


# ---- results kept up to date -----------------------------------------------------------

# A result is a folder of versions.  ``v`` of micro-batch i holds the groups that it changed, whole; ``c`` holds all groups up
# to i.  The current rows of a group are those of the latest version that has any.
_VERSION = re.compile(r"([vc])(\d{12})$")
_KEYS = "keys.json"
#: Micro-batches after which the changes so far are put together in one version.
COMPACT = 20
#: Seconds for which versions that a compact one has replaced stay, since a reader may still be at them.
RETAIN = 24 * 3600
_FROM = "__version"


def _version(path: str, i: int, kind: str = "v") -> str:
    return f"{path}/{kind}{i:012d}"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, float]]:
    """Finished versions in order: micro-batch, kind, time of change."""
    found = sorted((int(m.group(2)), m.group(1), at) for name, at in entries(spark, path) if (m := _VERSION.match(name)))
    return [v for v in found if exists(spark, f"{_version(path, v[0], v[1])}/_SUCCESS")]


def _current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The result as it was before a micro-batch, or as it is; None if there is none yet."""
    held = [v for v in _versions(spark, path) if before is None or v[0] < before]
    if not held:
        return None
    base = max((i for i, kind, _ in held if kind == "c"), default=-1)
    # a compact version and the change of the same micro-batch agree on that one
    used = [_version(path, i, kind) for i, kind, _ in held if kind == "c" and i == base or kind == "v" and i > base]
    keys = json.loads(spark.read.text(f"{path}/{_KEYS}", wholetext=True).first()[0])
    number = F.regexp_extract("_metadata.file_path", r"/[vc](\d{12})/[^/]*$", 1).cast("long")
    rows = spark.read.parquet(*used).withColumn(_FROM, number)
    group = Window.partitionBy(*[col(k) for k in keys])
    return rows.withColumn("__last", F.max(_FROM).over(group)).where(F.col(_FROM) == F.col("__last")).drop(_FROM, "__last")


def _store_changes(df: DataFrame, path: str, i: int, keys: Sequence[str]) -> None:
    """Write the groups that a micro-batch changed; now and then put all changes together and drop old versions."""
    spark = df.sparkSession
    write_once(spark, f"{path}/{_KEYS}", json.dumps(list(keys)))
    df.write.mode("overwrite").parquet(_version(path, i))
    if (i + 1) % COMPACT:
        return
    _current(spark, path, i + 1).write.mode("overwrite").parquet(_version(path, i, "c"))
    for old, kind, at in _versions(spark, path):
        # what this version replaces, unless it is new or the start of this micro-batch, should that run again
        if old <= i - COMPACT and at < time.time() - RETAIN:
            remove(spark, _version(path, old, kind))


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """The current result kept by ``keep_result`` or ``latest_stream``; it can be read for ``RETAIN`` seconds and more."""
    found = _current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no result at {path} yet")
    return found


def keep_result(
    result: DataFrame, path: str, checkpoint: str, by: str | Sequence[str] = (), state_partitions: int | None = None, **trigger
) -> StreamingQuery:
    """Keep a streaming aggregate's result at ``path``; ``by`` names the columns that tell its rows apart.

    A micro-batch writes the rows that it changed, so its cost follows its input and not the result, and state that the
    watermark closes is dropped.  Every micro-batch commits all state partitions, so an aggregate of few groups is best
    kept in few of them; their number is fixed when the checkpoint is new.
    """
    by = as_list(by)
    if set(by) - set(result.columns):
        raise ValueError(f"the result has no columns {sorted(set(by) - set(result.columns))}")
    conf, key = result.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(state_partitions or before))
    try:  # the query takes its settings when it starts
        return for_each_batch(result, lambda df, i: _store_changes(df, path, i, by), checkpoint, mode="update", **trigger)
    finally:
        conf.set(key, before)


def latest_stream(
    sdf: DataFrame,
    n: int,
    path: str,
    checkpoint: str,
    by: str | Sequence[str] = "stream",
    order_by: str | Sequence[str] = TIME_FIELD,
    state_partitions: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep the last ``n`` records of each stream, with their positions, at ``path``.

    They are the query's state, by stream, so a micro-batch reads and writes those of the streams that it has records of and no other; late records
    find their place by the order columns.  The number of state partitions is fixed when the checkpoint is new.
    """
    by = as_list(by)
    with state_settings(sdf.sparkSession, state_partitions):
        latest = latest_records(sdf, n, by, order_by)
        return for_each_batch(latest, lambda df, i: _store_changes(df, path, i, by), checkpoint, mode="update", **trigger)


def running_stream(
    sdf: DataFrame, field: str, path: str, checkpoint: str, delay: str, by: str | Sequence[str] | None = None,
    order_by: str | Sequence[str] = TIME_FIELD, state_partitions: int | None = None, **trigger,
) -> StreamingQuery:
    """Write every record with the statistics of ``field`` up to it (``keyed.running_records``) to Parquet folders under ``path``, one for each micro-batch."""
    with state_settings(sdf.sparkSession, state_partitions):
        out = running_records(sdf, field, delay, by, order_by)
        return for_each_batch(out, lambda df, i: df.write.mode("overwrite").parquet(_version(path, i)), checkpoint, **trigger)


def for_each_n(
    sdf: DataFrame, n: int, fn: BatchFn, checkpoint: str, order_by: str | Sequence[str] = TIME_FIELD,
    by: str | Sequence[str] | None = None, partial: bool = False, state_partitions: int | None = None, **trigger,
) -> StreamingQuery:
    """Run ``fn(records, id)`` on whole batches of exactly ``n`` records (columns ``seq`` and ``batch``, see ``keyed.record_batches``).

    One call may bring several batches, or none; a retried one brings the same.
    """
    with state_settings(sdf.sparkSession, state_partitions):
        return for_each_batch(record_batches(sdf, n, order_by, by, partial), fn, checkpoint, mode="update", **trigger)


def store_by(path: str, by: str | Sequence[str], change: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchFn:
    """A sink that keeps ``change(batch)`` at ``path``: rows of the groups ``by`` replace what was kept of them.  ``read_result`` reads it."""
    return lambda batch, i: _store_changes(change(batch), path, i, as_list(by))


def live_rate(sdf: DataFrame, seconds: float, delay: str = "1 minute", by: str | Sequence[str] | None = None) -> DataFrame:
    """Streaming ``rate``: ``[by..., TimeStamp, count, rate]``; late records count up to ``delay``."""
    by = as_list(by)
    timed = sdf.withColumn("__ts", F.timestamp_micros(micros(col(TIME_FIELD))))
    window = F.window("__ts", f"{interval_micros(seconds)} microseconds")
    return (
        timed.withWatermark("__ts", delay)
        .groupBy(window.alias("__w"), *[col(b) for b in by])
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *[col(b) for b in by],
            (F.unix_micros("__w.start") / F.lit(1e6)).alias(TIME_FIELD),
            "count",
            (F.col("count") / F.lit(float(seconds))).alias("rate"),
        )
    )


# ---- progress and stopping -------------------------------------------------------------


class _Progress(StreamingQueryListener):
    def __init__(self, fn):
        self.fn = fn

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        try:
            self.fn(event.progress)
        except Exception:
            log.exception("a progress callback failed; the stream goes on")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def on_progress(spark: SparkSession, fn: Callable) -> Callable[[], None]:
    """Call ``fn(progress)`` after each micro-batch; returns a function that unsubscribes.

    An exception in ``fn`` is logged and does not reach the stream.
    """
    listener = _Progress(fn)
    spark.streams.addListener(listener)
    return lambda: spark.streams.removeListener(listener)


def drain(query: StreamingQuery, again: Callable[[], StreamingQuery] | None = None) -> None:
    """Let a query read everything available, then stop it.

    A source that never pauses never runs dry.  For such a one pass ``again``, which starts the
    same query, on the same checkpoint, with ``available_now``: the query is stopped, and
    ``again`` reads on up to what is there now.
    """
    if again is not None:
        query.stop()
        query = again()
    if query.isActive:
        query.processAllAvailable()
    query.stop()
    failure = query.exception()
    if failure is not None:
        raise failure


def halt(query: StreamingQuery) -> None:
    """Stop now; what has not been read stays for the next start from the checkpoint."""
    query.stop()

