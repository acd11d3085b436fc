"""Named streams: a Parquet table per stream under one root, and a registry of their schemas.

The root must be a folder that all executors share.
"""

from __future__ import annotations

import json
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.ranges import col
from ..schema import TIME_FIELD, describe_fields, element_count, is_array, source_type, type_size
from . import arrival
from .paths import exists, write_once

REGISTRY = "_registry"

_REGISTRY_SCHEMA = "stream string, schema string"
CATALOG = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("field", T.StringType()),
        T.StructField("src_type", T.StringType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("bits", T.MapType(T.StringType(), T.IntegerType())),
    ]
)


def now() -> Column:
    """Current time as a record time: epoch seconds."""
    return F.unix_micros(F.current_timestamp()) / F.lit(1e6)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``df`` as records of ``schema``, matched by name.

    A missing ``TimeStamp`` becomes the current time; any other missing or extra column is
    an error.  Nulls, arrays of the wrong length and values that the field's type cannot hold as they are, text that is
    too long among them, fail the job rather than being changed.  Floats may lose digits.
    """
    missing = [n for n in schema.names if n not in df.columns and n != TIME_FIELD]
    extra = [n for n in df.columns if n not in schema.names]
    if missing or extra:
        raise ValueError(f"columns do not match the schema: missing {missing}, not in it {extra}")
    return df.select(*[_checked(df, f) for f in schema])


def _checked(df: DataFrame, f: T.StructField) -> Column:
    if f.name not in df.columns:
        return now().alias(f.name, metadata=f.metadata)
    # element nulls are checked here, whatever the input's type says about them
    dtype = T.ArrayType(f.dataType.elementType) if is_array(f) else f.dataType
    given = col(f.name)
    if is_array(f) and isinstance(df.schema[f.name].dataType, T.ArrayType):
        c = F.transform(given, lambda x: x.try_cast(f.dataType.elementType))
        changed = F.exists(F.arrays_zip(given.alias("a"), c.alias("b")), lambda z: _changed(z["a"], z["b"], f, df.schema[f.name].dataType.elementType))
    else:
        c = given.try_cast(dtype)
        changed = _changed(given, c, f, df.schema[f.name].dataType)
    problem = F.when(given.isNull(), F.lit(f"{f.name}: records hold no nulls"))
    problem = problem.when(changed, F.lit(f"{f.name}: value does not fit {source_type(f)}"))
    if is_array(f):
        problem = problem.when(F.size(c) != element_count(f), F.lit(f"{f.name}: wrong array length"))
        problem = problem.when(F.exists(c, lambda x: x.isNull()), F.lit(f"{f.name}: records hold no nulls"))
    src = source_type(f)
    if src.startswith("UInt") and not isinstance(f.dataType, T.LongType) or src == "UInt32":
        top = F.lit(str(2 ** (8 * type_size(src)) - 1)).cast("decimal(20,0)")
        if is_array(f):
            outside = F.exists(c, lambda x: (x < 0) | (x.cast("decimal(20,0)") > top))
        else:
            outside = (c < 0) | (c.cast("decimal(20,0)") > top)
        problem = problem.when(outside, F.lit(f"{f.name}: value does not fit {src}"))
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast(dtype)).otherwise(c)
    return checked.alias(f.name, metadata=f.metadata)


def _changed(given: Column, cast: Column, f: T.StructField, kind: T.DataType) -> Column:
    """Does a value that is not null come out of the cast as another?"""
    src = source_type(f)
    lost = given.isNotNull() & cast.isNull()
    if src == "Char":
        return lost | (F.length(cast) > element_count(f)) | cast.contains("\0")
    if src in ("Float", "Double", "Bool") or not isinstance(kind, T.NumericType):
        return lost
    return lost | F.coalesce(cast.cast("decimal(38,9)") != given.try_cast("decimal(38,9)"), given.isNotNull())


def _registry(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{REGISTRY}"
    if not exists(spark, path):
        return spark.createDataFrame([], _REGISTRY_SCHEMA)
    return spark.read.schema(_REGISTRY_SCHEMA).json(path)


def stream_schema(spark: SparkSession, root: str, name: str) -> T.StructType | None:
    """The schema a stream was registered with, or None."""
    row = _registry(spark, root).where(F.col("stream") == name).first()
    return T.StructType.fromJson(json.loads(row["schema"])) if row else None


def register_stream(spark: SparkSession, root: str, name: str, schema: T.StructType) -> None:
    """Name a stream and fix its schema.  Each stream has a file of its own in the registry, which is written once."""
    known = stream_schema(spark, root, name)
    if known is not None:
        if describe_fields(known) != describe_fields(schema):
            raise ValueError(f"stream {name!r} already has another schema")
        return
    write_once(spark, f"{root}/{REGISTRY}/{quote(name, safe='')}.json", json.dumps({"stream": name, "schema": schema.json()}))
    known = stream_schema(spark, root, name)  # of another call, if that was faster
    if known is None or describe_fields(known) != describe_fields(schema):
        raise ValueError(f"stream {name!r} already has another schema")


def catalog(spark: SparkSession, root: str, stream: str | None = None) -> DataFrame:
    """Every stream's fields: ``[stream, pos, field, src_type, count, bits]``; no rows if unknown."""
    meta = "struct<src_type: string, count: int, bits: map<string, int>>"
    fields = F.from_json("schema", f"fields array<struct<name: string, metadata: {meta}>>")["fields"]
    rows = _registry(spark, root)
    if stream is not None:
        rows = rows.where(F.col("stream") == stream)
    return rows.select("stream", F.posexplode(fields).alias("pos", "f")).select(
        "stream", "pos", F.col("f.name").alias("field"), "f.metadata.src_type", "f.metadata.count", "f.metadata.bits"
    )


def stream_path(root: str, name: str) -> str:
    return f"{root}/{quote(name, safe='')}"


def _arrow(values: np.ndarray) -> pa.Array:
    if values.dtype.kind == "S":
        values = np.char.decode(values, "latin-1")
    return pa.array(values.tolist() if values.ndim > 1 else np.ascontiguousarray(values))


def publish(df, root: str, name: str, batch: int | None = None) -> int:
    """Append records to a registered stream; returns how many were committed.

    Records come as a Spark or pandas frame, an Arrow table or a structured NumPy array.  They take the stream's next positions
    (see ``arrival``), in the order of ``df``'s partitions and rows.  With the id of a micro-batch, publishing it again after a failure adds nothing.
    """
    if isinstance(df, np.ndarray):
        if df.dtype.names is None:
            raise TypeError("an array of records needs named fields")
        df = pa.table({n: _arrow(df[n]) for n in df.dtype.names})
    if not isinstance(df, DataFrame):
        df = SparkSession.active().createDataFrame(df)
    schema = stream_schema(df.sparkSession, root, name)
    if schema is None:
        raise LookupError(f"stream {name!r} is not registered")
    return arrival.append(conform(df, schema), stream_path(root, name), schema, batch)


def known_schema(spark: SparkSession, root: str, name: str) -> T.StructType:
    """The schema of a named stream; an error if there is none of that name."""
    schema = stream_schema(spark, root, name)
    if schema is None:
        raise ConnectionError(f"no stream named {name!r}")
    return schema


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All records of a named stream so far."""
    schema = known_schema(spark, root, name)
    if not exists(spark, stream_path(root, name)):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(stream_path(root, name))
    return with_fields(table, schema)


def read_arrivals(spark: SparkSession, root: str, name: str, position: str = "position") -> DataFrame:
    """All records of a named stream with the positions in which they came, from 0."""
    schema = known_schema(spark, root, name)
    return with_fields(arrival.all_records(spark, stream_path(root, name), schema, position), schema)


def slice_published(spark: SparkSession, root: str, name: str, offset: int, count: int | None = None, position: str = "position") -> DataFrame:
    """Records at the arrival positions ``[offset, offset + count)``, or from ``offset`` on, in order.  Only files that hold some of them are opened.

    A negative ``offset`` counts back from the end.
    """
    schema, path = known_schema(spark, root, name), stream_path(root, name)
    end = arrival.end_position(spark, path)
    lo = max(0, end + offset) if offset < 0 else offset
    hi = end if count is None else min(end, lo + count)
    hit = (F.col("first") < hi) & (F.col("first") + F.col("count") > lo)
    out = arrival.some_records(spark, path, schema, hit, position).where((col(position) >= lo) & (col(position) < hi))
    return with_fields(out, schema).orderBy(position)


def published_between(spark: SparkSession, root: str, name: str, low: float, high: float, position: str = "position") -> DataFrame:
    """Records with times in ``[low, high]``, by time and, where times are equal, arrival.  Only files whose time bounds allow some are opened."""
    schema, path = known_schema(spark, root, name), stream_path(root, name)
    hit = (F.col("low") <= high) & (F.col("high") >= low)
    out = arrival.some_records(spark, path, schema, hit, position).where(col(TIME_FIELD).between(low, high))
    return with_fields(out, schema).orderBy(TIME_FIELD, position)


def end_position(spark: SparkSession, root: str, name: str) -> int:
    """How many records a named stream has taken in: the position of the next one."""
    known_schema(spark, root, name)
    return arrival.end_position(spark, stream_path(root, name))


def read_stream(spark: SparkSession, root: str, name: str, max_files: int = 1_000) -> DataFrame:
    """Live read of a named stream; ``max_files`` per micro-batch is the flow control."""
    schema = known_schema(spark, root, name)
    path = stream_path(root, name)
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.mode("append").parquet(path)
    files = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
    return with_fields(files.parquet(path), schema)


def with_fields(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Put the field metadata of ``schema`` on equally named columns."""
    return df.select(
        *[col(c).alias(c, metadata=schema[c].metadata) if c in schema.names else col(c) for c in df.columns]
    )
