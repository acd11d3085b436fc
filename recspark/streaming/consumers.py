"""Named consumers of a published stream, with cursors that outlive them.

A consumer reads the stream's arrival log live: a micro-batch takes the next publishes and opens only their files.  After
each micro-batch it writes its cursor, the number of records taken so far, so anyone can see how far behind it is, also
while it is down.  A micro-batch whose cursor is written is not handed over again when Spark repeats it.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.status import consumer_lag
from ..sources import arrival
from ..sources.paths import entries, exists, make_folder, read_text, remove, write_exclusive
from ..sources.streams import catalog, known_schema, stream_path, with_fields
from .live import BatchFn, for_each_batch

CURSORS = "_cursors"
#: Cursors of a consumer that stay; older ones go as new ones come.
KEPT = 20

_CURSOR = "stream string, consumer string, active boolean, run string, batch long, cursor long"


def _folder(root: str, name: str, consumer: str) -> str:
    return f"{root}/{CURSORS}/{quote(name, safe='')}/{quote(consumer, safe='')}"


def _file(run: str, batch: int) -> str:
    return f"{run}.{batch + 1:012d}.json"


def _store(spark: SparkSession, root: str, name: str, consumer: str, run: str, batch: int, cursor: int | None) -> None:
    entry = {"stream": name, "consumer": consumer, "active": cursor is not None, "run": run, "batch": batch, "cursor": cursor}
    write_exclusive(spark, f"{_folder(root, name, consumer)}/{_file(run, batch)}", json.dumps(entry))


def _own(spark: SparkSession, root: str, name: str, consumer: str, run: str) -> list[str]:
    """The names of a run's cursors, oldest first."""
    return sorted(n for n, _ in entries(spark, _folder(root, name, consumer)) if n.startswith(f"{run}.") and n.endswith(".json"))


def _fresh_run() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def watch(spark: SparkSession, root: str, name: str, consumer: str) -> None:
    """Name a passive consumer: it is listed, but has no cursor and holds nobody up."""
    known_schema(spark, root, name)
    _store(spark, root, name, consumer, _fresh_run(), -1, None)


def consume(
    spark: SparkSession, root: str, name: str, consumer: str, fn: BatchFn, checkpoint: str, max_publishes: int = 100, available_now: bool = False,
    interval: str | None = None, position: str = "position",
) -> StreamingQuery:
    """Run ``fn(records, id)`` on the records of each publish to a stream, with their positions, and keep the consumer's cursor.

    A micro-batch holds up to ``max_publishes`` publishes.  Started again with the same checkpoint, a consumer goes on behind its
    last whole micro-batch; with a new one it starts over, and its cursor with it.  If it is killed while ``fn`` runs, or before
    the cursor is written, ``fn`` gets the same records with the same id once more.
    """
    schema = known_schema(spark, root, name)
    path = stream_path(root, name)
    write_exclusive(spark, f"{checkpoint}/_consumer", _fresh_run())
    run = read_text(spark, f"{checkpoint}/_consumer")
    if not _own(spark, root, name, consumer, run):
        _store(spark, root, name, consumer, run, -1, 0)
    make_folder(spark, f"{path}/{arrival.LOG}")

    def take(publishes: DataFrame, i: int) -> None:
        session = publishes.sparkSession
        done = _own(session, root, name, consumer, run)
        if _file(run, i) in done:
            return
        publishes.persist()
        try:
            count = publishes.agg(F.sum("count")).first()[0] or 0
            fn(with_fields(arrival.records_of(publishes, path, schema, position), schema), i)
        finally:
            publishes.unpersist()
        last = json.loads(read_text(session, f"{_folder(root, name, consumer)}/{done[-1]}"))
        _store(session, root, name, consumer, run, i, last["cursor"] + count)
        for old in done[: -KEPT + 1]:
            remove(session, f"{_folder(root, name, consumer)}/{old}")

    return for_each_batch(arrival.live_log(spark, path, max_publishes), take, checkpoint, available_now, interval)


def cursors(spark: SparkSession, root: str) -> DataFrame:
    """The latest cursor of each consumer: ``[stream, consumer, cursor]``; null for a passive one."""
    if not exists(spark, f"{root}/{CURSORS}"):
        return spark.createDataFrame([], "stream string, consumer string, cursor long")
    rows = spark.read.schema(_CURSOR).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(f"{root}/{CURSORS}")
    last = F.max(F.struct("run", "batch", "cursor")).alias("last")
    return rows.groupBy("stream", "consumer").agg(last).select("stream", "consumer", F.col("last.cursor").alias("cursor"))


def ends(spark: SparkSession, root: str) -> DataFrame:
    """How many records each registered stream has taken in: ``[stream, total_written]``, from the logs alone."""
    names = catalog(spark, root).select("stream").distinct()
    logged = [(unquote(n), arrival.end_position(spark, f"{root}/{n}")) for n, _ in entries(spark, root) if exists(spark, f"{root}/{n}/{arrival.LOG}")]
    found = names.select("stream", F.lit(0).cast("long").alias("total_written")).union(spark.createDataFrame(logged, "stream string, total_written long"))
    return found.groupBy("stream").agg(F.max("total_written").alias("total_written"))


def live_lag(spark: SparkSession, root: str) -> DataFrame:
    """How far each consumer is behind the end of its stream: ``[stream, consumer, cursor, lag]``; no lag for a passive one."""
    return consumer_lag(ends(spark, root), cursors(spark, root))
