"""Spark data source ``records``: recordings in the binary section frame.

    spark.dataSource.register(RecordSource)
    df.write.format("records").option("alias", "Engine_1").mode("append").save(path)
    spark.read.format("records").load(path)

A scan is planned from the file listing alone.  Each task takes one byte range, walks the
section frames of its file and decodes the records that start in its range, so large files
split and the driver opens one file only (for the schema).  Conditions on ``TimeStamp`` reach the
scan: a task then looks up the index of its file and passes over blocks without such times.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

from ..schema import TIME_FIELD, record_dtype
from .frame import (
    DATA, HEADER, INDEX, TYPE_NAMES, Section, check_writable, decode, encode, frame, header_section, index_section, read_index, time_bounds, walk,
)
from .paths import open_fs, readable

SUFFIX = ".rec"
SPLIT_BYTES = 128 << 20
BLOCK_ROWS = 65_536
SECTION_BYTES = 64 << 20  # a writer holds at most about one section of this size
STAGING = "_staging"
OPEN_SECONDS = 7 * 24 * 3_600  # a file that has not changed for so long grows no more

FILE_COLUMNS = [
    T.StructField("_alias", T.StringType(), False),
    T.StructField("_file", T.StringType(), False),
    T.StructField("_pos", T.LongType(), False),
]


def list_files(path: str) -> list[pafs.FileInfo]:
    """Data files at a path, by name; names starting with ``_`` or ``.`` are hidden."""
    fs, root = open_fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no recording at {path}")
    if info.type == pafs.FileType.File:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    hidden = lambda p: any(part[:1] in "_." for part in p[len(root) :].strip("/").split("/"))
    return sorted((f for f in found if f.type == pafs.FileType.File and not hidden(f.path)), key=lambda f: f.path)


def first_schema(path: str) -> tuple[T.StructType, bool]:
    files = list_files(path)
    if not files:
        raise FileNotFoundError(f"no recording at {path}")
    fs, _ = open_fs(path)
    with fs.open_input_file(files[0].path) as f:
        for s in walk(f, files[0].size, files[0].path):
            if s.kind == HEADER:
                return s.schema, s.align
    raise ValueError(f"{files[0].path}: no header section")


@dataclass
class ByteRange(InputPartition):
    """Bytes of a file: the records that start there, or, in a file that is still ``growing``, those that end there."""

    path: str
    size: int
    lo: int
    hi: int
    growing: bool = False


def byte_ranges(size: int, split: int) -> list[tuple[int, int]]:
    return [(lo, min(lo + split, size)) for lo in range(0, size, split)]


def may_hold(blocks: np.ndarray, conditions: list[Filter]) -> np.ndarray:
    """Which blocks of an index may hold records that meet conditions on the time."""
    low, high, out = blocks["low"], blocks["high"], np.ones(len(blocks), bool)
    for c in conditions:
        if isinstance(c, (GreaterThan, GreaterThanOrEqual)):
            out &= ~(high <= c.value if isinstance(c, GreaterThan) else high < c.value)
        elif isinstance(c, (LessThan, LessThanOrEqual)):
            out &= low < c.value if isinstance(c, LessThan) else low <= c.value
        else:
            values = c.value if isinstance(c, In) else (c.value,)
            out &= np.any([(low <= v) & ~(high < v) for v in values], axis=0)
    return out


def _on_time(c: Filter) -> bool:
    """Whether an index can tell which blocks meet a condition: one that compares the time with plain numbers."""
    if not isinstance(c, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or c.attribute != (TIME_FIELD,):
        return False
    values = c.value if isinstance(c, In) else (c.value,)
    return len(values) > 0 and all(isinstance(v, float) and v == v for v in values)


def _runs(s: Section, first: int, last: int, blocks: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """The records ``[first, last)`` of a section that its ``blocks`` cover, a block of them at a time; all of them without an index."""
    runs = [[first, last]]
    if blocks is not None:
        runs = []
        for b in blocks[blocks["section"] == s.idx]:
            lo, hi = max(first, int(b["at"])), min(last, int(b["at"] + b["n"]))
            if lo < hi and runs and runs[-1][1] == lo:
                runs[-1][1] = hi
            elif lo < hi:
                runs.append([lo, hi])
    for lo, hi in runs:
        for at in range(lo, hi, BLOCK_ROWS):
            yield at, min(BLOCK_ROWS, hi - at)


def read_range(fs, rng: ByteRange, schema: T.StructType, out: pa.Schema, conditions: list[Filter] = ()) -> Iterator[pa.RecordBatch]:
    """Records of one file that start in a byte range, in blocks.  Blocks in which no time meets the conditions are not read."""
    wanted = T.StructType([f for f in schema if f.name not in ("_alias", "_file", "_pos")])
    with fs.open_input_file(rng.path) as f:
        blocks = read_index(f, rng.size) if conditions else None
        if blocks is not None:
            blocks = blocks[may_hold(blocks, conditions)]
        for s in walk(f, rng.size, rng.path, rng.growing):
            if s.start >= rng.hi:
                break
            if s.kind != DATA:
                continue
            here = {f.name: f.dataType for f in s.schema}
            if any(here.get(f.name) != f.dataType for f in wanted):
                raise ValueError(f"{rng.path}: its schema differs from the one read: {s.schema.simpleString()}")
            width = s.dtype.itemsize
            up = 0 if rng.growing else width - 1
            first = max(0, (rng.lo - s.start + up) // width)
            last = min(s.records, max(0, (rng.hi - s.start + up) // width))
            for at, n in _runs(s, first, last, blocks):
                f.seek(s.start + at * width)
                columns = dict(zip(wanted.names, decode(f.read(n * width), s, wanted)))
                start = s.first_record + at
                if "_alias" in schema.names:
                    columns["_alias"] = pa.repeat(pa.scalar(s.alias, pa.string()), n)
                if "_file" in schema.names:
                    columns["_file"] = pa.repeat(pa.scalar(rng.path, pa.string()), n)
                if "_pos" in schema.names:
                    columns["_pos"] = pa.array(np.arange(start, start + n))
                yield pa.RecordBatch.from_arrays([columns[c].cast(out.field(c).type) for c in schema.names], schema=out)


class RecordReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, split: int):
        self.path, self.schema, self.split = path, schema, split
        self.conditions: list[Filter] = []

    def partitions(self):
        parts = [ByteRange(f.path, f.size, lo, hi) for f in list_files(self.path) for lo, hi in byte_ranges(f.size, self.split)]
        return parts or [ByteRange("", 0, 0, 0)]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.path:
            fs, _ = open_fs(self.path)
            yield from read_range(fs, partition, self.schema, to_arrow_schema(self.schema), self.conditions)


class IndexedReader(RecordReader):
    """A reader that takes conditions on the time; Spark still applies all of them to the records that come."""

    def pushFilters(self, filters):
        self.conditions = [c for c in filters if _on_time(c)]
        return filters


class RecordStreamReader(DataSourceStreamReader):
    """New files of a folder, and what is added to those that are there, as of each listing.

    An offset holds how many bytes of each file have been taken, for files that have changed within ``open_seconds`` of the
    newest one; older files are closed and need no entry, so offsets do not grow with the recording.  A record is taken
    once its last byte is there.  Files are only ever appended to, and closed ones not any more; a file that
    comes with a time of change older than that is passed over, as Spark's file source does.
    """

    def __init__(self, path: str, schema: T.StructType, split: int, open_seconds: int):
        self.path, self.schema, self.split, self.open_seconds = path, schema, split, open_seconds

    def _listed(self) -> list[tuple[str, int, int]]:
        """Path, size and time of change (in milliseconds) of each file."""
        return [(f.path, f.size, f.mtime_ns // 1_000_000) for f in list_files(self.path)]

    def initialOffset(self):
        return {"since": 0, "files": {}}

    def latestOffset(self):
        files = self._listed()
        since = max(0, max((at for _, _, at in files), default=0) - 1_000 * self.open_seconds)
        return {"since": since, "files": {path: size for path, size, at in files if at >= since}}

    def partitions(self, start, end):
        if start == end:
            return []
        upto = dict(end["files"])
        if start["since"] < end["since"]:  # files that have been closed in between
            upto |= {path: size for path, size, at in self._listed() if start["since"] <= at < end["since"] and path not in upto}
        taken = start["files"]
        return [
            ByteRange(path, size, lo, min(lo + self.split, size), growing=True)
            for path, size in sorted(upto.items())
            for lo in range(taken.get(path, 0), size, self.split)
        ]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = open_fs(self.path)
        yield from read_range(fs, partition, self.schema, to_arrow_schema(self.schema))


@dataclass
class Written(WriterCommitMessage):
    name: str


class StagedFiles:
    """Each task writes one uniquely named file out of sight; the commit moves those that count."""

    def __init__(self, path: str, schema: T.StructType, align: bool, alias: str):
        check_writable(schema)
        self.path, self.schema, self.align, self.alias = path, schema, align, alias
        self.job = uuid.uuid4().hex

    def _staged(self, root: str) -> str:
        return f"{root}/{STAGING}-{self.job}"

    def write(self, iterator):
        from pyspark import TaskContext

        fs, root = open_fs(self.path)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{uuid.uuid4().hex}{SUFFIX}"
        fs.create_dir(self._staged(root))
        dtype = record_dtype(self.schema, self.align)
        with fs.open_output_stream(f"{self._staged(root)}/{name}") as out:
            out.write(header_section(self.schema, self.align, self.alias))
            held, size, sections, blocks = [], 0, 0, []
            for batch in iterator:
                if not batch.num_rows:
                    continue
                held.append(encode(batch, self.schema, dtype))
                blocks.append((sections + 1, size // dtype.itemsize, batch.num_rows, *time_bounds(held[-1], dtype)))
                size += len(held[-1])
                if size >= SECTION_BYTES:
                    self._data(out, held, size)
                    held, size, sections = [], 0, sections + 1
            if size or not sections:
                self._data(out, held, size)
            if blocks:
                out.write(index_section(blocks, self.alias, out.tell()))
        return Written(name)

    def _data(self, out, held: list[bytes], size: int) -> None:
        out.write(frame(DATA, self.alias, size))
        for block in held:
            out.write(block)

    def _publish(self, messages, prefix: str, old: list[str]) -> None:
        """Put the files of ``messages`` where readers see them, and take away ``old`` ones."""
        fs, root = open_fs(self.path)
        with ThreadPoolExecutor(16) as pool:
            names = [m.name for m in messages if m is not None]
            list(pool.map(lambda n: fs.move(f"{self._staged(root)}/{n}", f"{root}/{prefix}{n}"), names))
            list(pool.map(fs.delete_file, old))
        self._clean()

    def _clean(self) -> None:
        fs, root = open_fs(self.path)
        if fs.get_file_info(self._staged(root)).type != pafs.FileType.NotFound:
            fs.delete_dir(self._staged(root))


class RecordWriter(StagedFiles, DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, align: bool, alias: str, overwrite: bool):
        super().__init__(path, schema, align, alias)
        self.overwrite = overwrite

    def commit(self, messages):
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        self._publish(messages, "", [f.path for f in list_files(self.path)] if self.overwrite else [])

    def abort(self, messages):
        self._clean()


class RecordStreamWriter(StagedFiles, DataSourceStreamArrowWriter):
    """Files carry the name of their query and the number of their micro-batch, so a micro-batch that is repeated replaces what it left before."""

    def __init__(self, path: str, schema: T.StructType, align: bool, alias: str, query: str):
        super().__init__(path, schema, align, alias)
        self.query = self.job = query  # Spark makes a writer for the tasks and another for the commit

    def commit(self, messages, batchId):
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        prefix = f"{self.query}-{batchId:012d}-"
        here = fs.get_file_info(pafs.FileSelector(root))
        self._publish(messages, prefix, [f.path for f in here if f.base_name.startswith(prefix)])

    def abort(self, messages, batchId):
        self._clean()


class RecordSource(DataSource):
    """Options: ``path``; read: ``fields`` (comma-separated), ``splitBytes``, ``pushdown``; live read: also ``openSeconds``; write: ``alias``, ``align``.

    With ``pushdown`` conditions on the time reach the scan, for which the session must allow it, as ``read_recordings`` sees to.
    """

    @classmethod
    def name(cls):
        return "records"

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("the records source needs a path")
        open_fs(path)  # a path that means something else to Spark is refused at planning
        return path

    def schema(self):
        schema, _ = first_schema(self._path())
        if self.options.get("fields"):
            schema = T.StructType([schema[n.strip()] for n in self.options["fields"].split(",")])
        return T.StructType([*schema.fields, *FILE_COLUMNS])

    def reader(self, schema):
        kind = IndexedReader if self.options.get("pushdown", "false").lower() == "true" else RecordReader
        return kind(self._path(), schema, int(self.options.get("splitBytes", SPLIT_BYTES)))

    def streamReader(self, schema):
        options = self.options
        return RecordStreamReader(self._path(), schema, int(options.get("splitBytes", SPLIT_BYTES)), int(options.get("openSeconds", OPEN_SECONDS)))

    def writer(self, schema, overwrite):
        align = self.options.get("align", "false").lower() == "true"
        return RecordWriter(self._path(), schema, align, self.options.get("alias", ""), overwrite)

    def streamWriter(self, schema, overwrite):
        align = self.options.get("align", "false").lower() == "true"
        query = hashlib.md5(self.options.get("checkpointLocation", "").encode()).hexdigest()[:12]
        return RecordStreamWriter(self._path(), schema, align, self.options.get("alias", ""), query)


SECTIONS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("body_length", T.LongType()),
        T.StructField("n_fields", T.IntegerType()),
        T.StructField("rec_size", T.IntegerType()),
        T.StructField("n_records", T.LongType()),
    ]
)


def _found_files(reader, path: str) -> DataFrame:
    """Paths and lengths as Spark's file source lists them; contents are not read."""
    return (
        reader.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def sections(spark: SparkSession, path: str) -> DataFrame:
    """Section inventory of recordings, one row per section, without reading data bodies.  A file's index is no section of the recording."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(SECTIONS)

    def inspect(batches):
        for batch in batches:
            rows = []
            for uri, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                fs, file = open_fs(uri)
                with fs.open_input_file(file) as f:
                    rows += [
                        {
                            "file": file,
                            "idx": s.idx,
                            "type": TYPE_NAMES.get(s.kind, f"Unknown({s.kind})"),
                            "name": s.alias,
                            "body_length": s.length,
                            "n_fields": len(s.schema) if s.schema is not None else None,
                            "rec_size": s.dtype.itemsize if s.dtype is not None else None,
                            "n_records": s.records,
                        }
                        for s in walk(f, size, file)
                        if s.kind != INDEX
                    ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return _found_files(spark.read, path).mapInArrow(inspect, SECTIONS)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordSource)


def read_recordings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Recordings as a table.  Conditions on ``TimeStamp`` reach the scan, so a time range reads the blocks that may hold it."""
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("records").options(**{"pushdown": "true", **options}).load(readable(spark, path))


def write_recordings(df: DataFrame, path: str, alias: str = "", align: bool = False, mode: str = "append") -> None:
    register(df.sparkSession)
    df.write.format("records").options(alias=alias, align=str(align).lower()).mode(mode).save(readable(df.sparkSession, path))


def write_recordings_live(df: DataFrame, path: str, checkpoint: str, alias: str = "", align: bool = False, available_now: bool = False) -> StreamingQuery:
    """Record a live stream as it comes: each micro-batch adds files to the recording, once, also if it is repeated after a failure."""
    register(df.sparkSession)
    writer = df.writeStream.format("records").option("checkpointLocation", checkpoint).options(alias=alias, align=str(align).lower())
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(readable(df.sparkSession, path))


def follow_recordings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Live read of recordings while they are written: new files, and what is added to a file, each record once.

    A micro-batch takes all that is there when it starts; :func:`stream_recordings` takes whole files, a number at a time.
    The folder must hold a header already, for the schema.
    """
    register(spark)
    return spark.readStream.format("records").options(**options).load(readable(spark, path))


def stream_recordings(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, max_files: int = 1_000) -> DataFrame:
    """Live read of recordings as they arrive: the file source lists, tasks decode byte ranges.

    Only paths and lengths come from the file source, so a file's size is not limited by a row.
    The folder must hold a file already, for the schema.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, _ = first_schema(readable(spark, path))
    full = T.StructType([*schema.fields, *FILE_COLUMNS])
    arrow = to_arrow_schema(full)
    files = _found_files(spark.readStream.option("maxFilesPerTrigger", max_files).option("pathGlobFilter", f"*{SUFFIX}"), path)
    ranges = files.withColumn(
        "lo", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")), F.lit(split_bytes).cast("long")))
    )

    def read_files(batches):
        for batch in batches:
            for r in batch.to_pylist():
                fs, local = open_fs(r["path"])
                rng = ByteRange(local, r["length"], r["lo"], min(r["lo"] + split_bytes, r["length"]))
                yield from read_range(fs, rng, full, arrow)

    return ranges.repartition(F.col("path"), F.col("lo")).mapInArrow(read_files, full)
