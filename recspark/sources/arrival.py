"""The arrival log of a named stream: which records came when, as positions that never change.

Each publish writes its files out of sight, claims the next range of positions with one log entry, whose name only one publisher can take,
and then moves its folder into the stream.  An entry lists the publish's files with first position, number of records and time
bounds.  So a position leads to a file by the log alone, and records with equal times keep the order in which they came: by publish, and in
a publish by partition and row.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.ranges import col
from ..schema import TIME_FIELD
from .paths import entries, exists, move, read_text, remove, write_exclusive

LOG = "_log"
STAGED = "_staged-"
#: A record's place in its publish, before files get their first positions.
AT = "_at"
#: Seconds after which a folder that no entry knows is taken for the leftover of a failed publish.
FORGOTTEN = 24 * 3600

_FILES = "array<struct<file: string, first: long, count: long, at: long, low: double, high: double>>"
_ENTRY = f"n long, first long, count long, folder string, id string, files {_FILES}"
_NAME = re.compile(r"(\d{12})\.json$")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(m.group(1)) for name, _ in entries(spark, f"{path}/{LOG}") if (m := _NAME.match(name)))


def _entry(spark: SparkSession, path: str, n: int) -> dict:
    return json.loads(read_text(spark, f"{path}/{LOG}/{n:012d}.json"))


def log(spark: SparkSession, path: str) -> DataFrame:
    """All entries of a stream's log, one row for each publish."""
    if not _numbers(spark, path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(f"{path}/{LOG}/*.json")


def _files(spark: SparkSession, folder: str, schema: T.StructType) -> list[dict]:
    """What a publish wrote: a row per file, in order, with positions from 0."""
    time_of = F.col(TIME_FIELD) if TIME_FIELD in schema.names else F.lit(None).cast("double")
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(AT, T.LongType())])).parquet(folder)
    found = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("count"), F.min(AT).alias("at"), F.min(time_of).alias("low"), F.max(time_of).alias("high")
    )
    out, first = [], 0
    for r in sorted(found.collect(), key=lambda r: r["at"]):
        out.append({**r.asDict(), "first": first})
        first += r["count"]
    return out


def _commit(spark: SparkSession, path: str, own: str, folder: str, files: list[dict]) -> None:
    """Claim the next positions for the publish ``own``, unless that has been done."""
    count = sum(f["count"] for f in files)
    if log(spark, path).where(F.col("id") == own).head(1):
        return
    seen = _numbers(spark, path)
    while True:
        last = _entry(spark, path, seen[-1]) if seen else {"n": -1, "first": 0, "count": 0}
        n, first = last["n"] + 1, last["first"] + last["count"]
        placed = [{**f, "first": first + f["first"]} for f in files]
        text = json.dumps({"n": n, "first": first, "count": count, "folder": folder, "id": own, "files": placed})
        if write_exclusive(spark, f"{path}/{LOG}/{n:012d}.json", text):
            return
        # another publish was faster; it may be another try of this one
        now = _numbers(spark, path)
        if any(_entry(spark, path, i)["id"] == own for i in now[len(seen) :]):
            return
        seen = now


def settle(spark: SparkSession, path: str) -> None:
    """Finish publishes that claimed their positions and then failed to move their folder; drop what failed before that."""
    staged = {name[len(STAGED) :]: at for name, at in entries(spark, path) if name.startswith(STAGED)}
    if not staged:
        return
    known = {r["id"]: r["folder"] for r in log(spark, path).where(F.col("id").isin(*staged)).select("id", "folder").collect()}
    for own, at in staged.items():
        if own in known:
            move(spark, f"{path}/{STAGED}{own}", f"{path}/{known[own]}")
        elif at < time.time() - FORGOTTEN:
            remove(spark, f"{path}/{STAGED}{own}")


def append(rows: DataFrame, path: str, schema: T.StructType, batch: int | None = None) -> int:
    """Add the records ``rows`` to the stream at ``path``; returns how many came in.

    With the id of a micro-batch, all tries of it together add its records once, also if one of them failed half way.
    """
    spark = rows.sparkSession
    settle(spark, path)
    folder = f"part-{uuid.uuid4().hex}" if batch is None else f"batch-{batch:012d}"
    if batch is not None and exists(spark, f"{path}/{folder}"):
        return 0
    own = uuid.uuid4().hex
    rows.withColumn(AT, F.monotonically_increasing_id()).write.parquet(f"{path}/{STAGED}{own}")
    files = _files(spark, f"{path}/{STAGED}{own}", schema)
    if not files:
        remove(spark, f"{path}/{STAGED}{own}")
        return 0
    if batch is not None and not write_exclusive(spark, f"{path}/{LOG}/{folder}.owner", own):
        remove(spark, f"{path}/{STAGED}{own}")
        first = read_text(spark, f"{path}/{LOG}/{folder}.owner")  # the try that got furthest; its records are whole
        if exists(spark, f"{path}/{STAGED}{first}"):
            _commit(spark, path, first, folder, _files(spark, f"{path}/{STAGED}{first}", schema))
            move(spark, f"{path}/{STAGED}{first}", f"{path}/{folder}")
        return 0
    _commit(spark, path, own, folder, files)
    move(spark, f"{path}/{STAGED}{own}", f"{path}/{folder}")
    return sum(f["count"] for f in files)


# ---- reading -----------------------------------------------------------------------------


def _placed(records: DataFrame, files: DataFrame, position: str) -> DataFrame:
    """Records with their positions: the first of their file and their place in it."""
    names = [c for c in records.columns if c != AT]
    bases = files.select(F.col("file").alias("__file"), (F.col("first") - F.col("at")).alias("__base"))
    out = records.select("*", F.col("_metadata.file_name").alias("__file")).join(bases, "__file")
    return out.select(*[col(c) for c in names], (F.col("__base") + F.col(AT)).alias(position))


def _records(spark: SparkSession, schema: T.StructType, *paths: str) -> DataFrame:
    with_at = T.StructType([*schema.fields, T.StructField(AT, T.LongType())])
    return spark.read.schema(with_at).option("recursiveFileLookup", True).parquet(*paths)


def _listed(publishes: DataFrame) -> DataFrame:
    return publishes.select("folder", F.explode("files").alias("f")).select("folder", "f.*")


def end_position(spark: SparkSession, path: str) -> int:
    """The position that the next record will have: how many have come in."""
    seen = _numbers(spark, path)
    if not seen:
        return 0
    last = _entry(spark, path, seen[-1])
    return last["first"] + last["count"]


def all_records(spark: SparkSession, path: str, schema: T.StructType, position: str = "position") -> DataFrame:
    """All records with their positions."""
    settle(spark, path)
    if not end_position(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(position, T.LongType())]))
    return _placed(_records(spark, schema, path), _listed(log(spark, path)), position)


def some_records(spark: SparkSession, path: str, schema: T.StructType, hit, position: str = "position") -> DataFrame:
    """The records of the files for which ``hit`` (a condition on ``first``, ``count``, ``low``, ``high``) holds; no other is opened."""
    return records_of(log(spark, path), path, schema, position, hit)


def records_of(publishes: DataFrame, path: str, schema: T.StructType, position: str = "position", hit=None) -> DataFrame:
    """The records of some entries of the log, of all their files or those for which ``hit`` holds."""
    spark = publishes.sparkSession
    settle(spark, path)
    files = _listed(publishes) if hit is None else _listed(publishes).where(hit)
    paths = [f"{path}/{r['folder']}/{r['file']}" for r in files.select("folder", "file").collect()]
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(position, T.LongType())]))
    return _placed(_records(spark, schema, *paths), files, position)


def live_log(spark: SparkSession, path: str, max_publishes: int) -> DataFrame:
    """The entries of the log as they come."""
    files = spark.readStream.schema(_ENTRY).option("maxFilesPerTrigger", max_publishes).option("pathGlobFilter", "[0-9]*.json")
    return files.json(f"{path}/{LOG}")
