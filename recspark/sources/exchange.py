"""Records in and out of other forms: CSV files, user code, pandas."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ordering import as_list, latest
from ..plans.ranges import col
from ..schema import TIME_FIELD, element_count, is_array
from ..workspace import drop, work_dir
from .recordings import read_recordings


def _csv_number(c: Column) -> Column:
    """Six decimals, as C's printf writes them, also for values that are not finite."""
    d = c.cast("double")
    return (
        F.when(F.isnan(d), "nan")
        .when(d == float("inf"), "inf")
        .when(d == float("-inf"), "-inf")
        .otherwise(F.format_string("%.6f", d))
    )


#: A quoted or plain value of a CSV line, after the line's start or a comma.
_CSV_VALUE = r'(?:^|,)("(?:[^"\\]++|\\.)*+"|[^,]*+)'
#: How lines that are put together already pass through the CSV writer: no value holds this separator, and nothing is quoted again.
_WHOLE_LINES = {"sep": "\u0001", "quote": "", "emptyValue": ""}
_KEEP_BLANKS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _time_first(schema: T.StructType) -> list[T.StructField]:
    return sorted(schema, key=lambda f: f.name != TIME_FIELD)


def _csv_value(base: T.DataType) -> Callable[[Column], Column]:
    """The text of a value, before any quoting."""
    return _csv_number if isinstance(base, (T.FloatType, T.DoubleType)) else lambda c: c


def _quoted(text: Column) -> Column:
    """Text in quotes if a CSV line needs them: it is empty or holds a comma, a quote, a backslash or a line end."""
    inside = F.regexp_replace(text, r'(["\\])', r"\\$1")
    return F.when((text == "") | text.rlike(r'[",\\\r\n]'), F.concat(F.lit('"'), inside, F.lit('"'))).otherwise(text)


def csv_header(schema: T.StructType) -> str:
    """The header line of a CSV file; an array field has a column for each element."""
    names = []
    for f in _time_first(schema):
        names += [f"{f.name}[{i}]" for i in range(element_count(f))] if is_array(f) else [f.name]
    quoted = lambda n: '"' + n.replace("\\", "\\\\").replace('"', '\\"') + '"' if set(n) & set('",\\\r\n') else n
    return ",".join(map(quoted, names))


def _elements_line(f: T.StructField) -> Column:
    """The values of an array field, as many as it declares, one after the other."""
    text = _csv_value(f.dataType.elementType)
    places = F.sequence(F.lit(0), F.lit(element_count(f) - 1))
    return F.array_join(F.transform(places, lambda i: F.coalesce(text(F.get(col(f.name), i)).cast("string"), F.lit(""))), ",")


def csv_line(df: DataFrame) -> Column:
    """A record as one CSV line.  An array is one expression however long it is."""
    parts = []
    for f in _time_first(df.schema):
        if is_array(f):
            part = _elements_line(f)
        elif isinstance(f.dataType, T.StringType):
            part = _quoted(col(f.name))
        else:
            part = _csv_value(f.dataType)(col(f.name)).cast("string")
        parts.append(F.coalesce(part, F.lit("")))
    return F.concat_ws(",", *parts)


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write records as CSV: ``TimeStamp`` first, floats with six decimals, a column per array element.

    Every part file starts with its header line, and an empty input still writes one; reading
    the folder as one CSV table gives each record once.
    """
    if any(is_array(f) for f in df.schema):
        df.select(csv_line(df).alias(csv_header(df.schema))).write.mode(mode).options(**_KEEP_BLANKS, **_WHOLE_LINES).csv(path)
        return
    columns = [_csv_value(f.dataType)(col(f.name)).alias(f.name) for f in _time_first(df.schema)]
    df.select(*columns).write.mode(mode).options(**_KEEP_BLANKS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records that :func:`write_csv` wrote: array fields put together again, text and values that are not finite as they were."""
    if any(is_array(f) for f in schema):
        return _read_lines(spark, path, schema)
    flat = T.StructType([T.StructField(f.name, f.dataType) for f in _time_first(schema)])
    options = {"nanValue": "nan", "positiveInf": "inf", "negativeInf": "-inf", "emptyValue": ""}
    rows = spark.read.schema(flat).options(**_KEEP_BLANKS, **options).csv(path)

    def value(f: T.StructField) -> Column:
        return F.coalesce(col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType) else col(f.name)  # records hold no nulls

    return rows.select(*[value(f).alias(f.name, metadata=f.metadata) for f in schema])


def _read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV lines cut into values once; a field takes its values by their places, an array a slice of them.

    A value that does not fit its type is null, as with Spark's own reader.  The header lines of the files are left out.
    """
    line, values = F.col("value"), F.col("values")
    first = line.startswith(f"{TIME_FIELD},")  # no time looks like this
    if any(isinstance(f.dataType, T.StringType) for f in schema):
        cut = F.regexp_extract_all(line, F.lit(_CSV_VALUE), 1)
    else:
        cut = F.split(line, ",", -1)
    # as a generated row, so that the line is cut once and not once for each field
    rows = spark.read.text(path).where(~first & (line != "")).select(F.explode(F.array(cut)).alias("values"))
    places, at = {}, 0
    for f in _time_first(schema):
        places[f.name] = at
        at += element_count(f) if is_array(f) else 1

    def typed(f: T.StructField) -> Column:
        here = F.get(values, F.lit(places[f.name]))
        if is_array(f):
            kind = f.dataType.elementType
            return F.transform(F.slice(values, places[f.name] + 1, element_count(f)), lambda x: x.try_cast(kind))
        if not isinstance(f.dataType, T.StringType):
            return here.try_cast(f.dataType)
        plain = F.regexp_replace(F.substring(here, F.lit(2), F.length(here) - 2), r"\\(.)", r"$1")
        return F.coalesce(F.when(here.startswith('"'), plain).otherwise(here), F.lit(""))

    return rows.select(*[typed(f).alias(f.name, metadata=f.metadata) for f in schema])


Produce = Callable[[np.ndarray], pd.DataFrame | Mapping]


def produce(indexes: DataFrame, schema: T.StructType, fn: Produce, on_start=None, on_stop=None) -> DataFrame:
    """Records made by user code from a column of start indexes.

    ``fn`` gets a block of indexes and returns the columns of at most as many records.  It
    keeps no state between blocks, so blocks run in parallel.  A missing ``TimeStamp`` is
    filled with the current time.
    """
    names = schema.names

    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        if on_start:
            on_start()
        try:
            for block in blocks:
                rows = pd.DataFrame(fn(block.iloc[:, 0].to_numpy()))
                if len(rows) > len(block):
                    raise ValueError(f"the producer made {len(rows)} records for {len(block)} indexes")
                if not len(rows):
                    continue
                if TIME_FIELD not in rows:
                    rows[TIME_FIELD] = time.time()
                yield rows[names]
        finally:
            if on_stop:
                on_stop()

    return indexes.mapInPandas(run, schema)


def each_record(step: Callable[[int], Mapping | None]) -> Produce:
    """A per-record producer as a block producer; ``None`` makes no record."""

    def fn(index: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame([r for r in (step(int(i)) for i in index) if r is not None])

    return fn


def from_producer(spark: SparkSession, schema: T.StructType, fn: Produce, n: int, **hooks) -> DataFrame:
    """``n`` records made by user code, for indexes 0 to n-1."""
    return produce(spark.range(n), schema, fn, **hooks)


def producer_stream(spark: SparkSession, schema: T.StructType, fn: Produce, per_second: int, **hooks) -> DataFrame:
    """Records made by user code as a live stream."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return produce(ticks.select("value"), schema, fn, **hooks)


def to_frame(src: DataFrame | str, n: int | None, order_by=TIME_FIELD, spark: SparkSession | None = None) -> pd.DataFrame:
    """A snapshot as pandas: the last ``n`` records of a DataFrame or a recording, or with None all, oldest first.

    The driver holds what it returns, so the caller names the bound.
    """
    return _snapshot(src, n, order_by, spark).toPandas()


def to_arrow(src: DataFrame | str, n: int | None, order_by=TIME_FIELD, spark: SparkSession | None = None) -> pa.Table:
    """The same snapshot as an Arrow table."""
    return _snapshot(src, n, order_by, spark).toArrow()


def arrow_batches(src: DataFrame | str, order_by=TIME_FIELD, spark: SparkSession | None = None) -> Iterator[pa.RecordBatch]:
    """All records, oldest first, as Arrow batches for code on the driver, which holds one range of them at a time.

    The records are sorted once into ranges in the shared folder, one partition each; then range after range is fetched.  A
    range is one partition of Spark's sort, so it has about the size that Spark gives partitions after a shuffle.
    Rows equal in ``order_by`` come in any order.
    """
    rows = _snapshot(src, None, order_by, spark)
    order = [col(c) for c in as_list(order_by)]
    session, names = rows.sparkSession, rows.columns
    ranged = rows.select(F.struct(*[col(c) for c in names]).alias("row"), F.spark_partition_id().alias("part"))
    path = work_dir(session, "handover")
    ranged.write.partitionBy("part").parquet(path)
    table = session.read.schema(ranged.schema).parquet(path)
    try:
        for (part,) in sorted(table.select("part").distinct().collect()):
            yield from table.where(F.col("part") == part).select("row.*").orderBy(*order).toArrow().to_batches()
    finally:
        drop(session, path)


def _snapshot(src: DataFrame | str, n: int | None, order_by, spark: SparkSession | None) -> DataFrame:
    if isinstance(src, str):
        src = read_recordings(spark or SparkSession.active(), src)
    if not isinstance(src, DataFrame):
        raise TypeError(f"cannot take a snapshot of {type(src).__name__}")
    if src.isStreaming:
        raise TypeError("a live stream has no snapshot; keep its latest records with latest_stream")
    if n is None:
        return src.orderBy(*[col(c) for c in as_list(order_by)])
    return latest(src, n, order_by).drop("seq")
