"""Live streams with state of their own for each stream: the latest records, running statistics per record, batches of exactly n.

State lies in RocksDB, keyed by stream, so a micro-batch reads and writes that of the streams it has records of and no other.  It is
committed with the micro-batch's offsets: a query that is killed and started again neither skips nor repeats a record.

Streams may be many and have few records each.  So the latest records and running statistics are worked out for a bucket of streams
at a time, in columns, and the streams of a bucket that a hash deals to the same part share one entry of state: a micro-batch costs
as many reads and writes as there are parts, however many streams it touches, and one that touches few reads the parts they are in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.ordering import as_list
from ..operators.stats import micros
from ..plans.ranges import col
from ..schema import TIME_FIELD

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MORE, _ONE, _WHEN, _KEY, _PART, _BUCKET = "__more", "__one", "__when", "__key", "__part", "__bucket"
#: Streams are dealt to so many buckets by a hash; their number is fixed while a checkpoint lasts.
BUCKETS = 512
#: Parts of a bucket's streams that share an entry of state; a stream that keeps more records than FEW has one of its own.
PARTS, FEW = 4, 100
#: Records that wait in one piece of state.
PIECE = 10_000


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """What a query with keyed state has to find when it starts."""
    # a commit then writes what changed and not the whole store
    want = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    if partitions:
        want["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _packed_parts(pdf: pd.DataFrame, ends: Sequence[int]) -> Iterator[bytes]:
    """The rows up to each of ``ends`` from the one before, each part by itself."""
    table = pa.Table.from_pandas(pdf, preserve_index=False).replace_schema_metadata(None)
    start = 0
    for end in ends:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(start, end - start))
        yield sink.getvalue().to_pybytes()
        start = end


def _packed(pdf: pd.DataFrame) -> bytes:
    (data,) = _packed_parts(pdf, [len(pdf)])
    return data


def _unpacked(*data: bytes) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(d).read_all() for d in data]
    return pa.concat_tables(tables, promote_options="permissive").to_pandas()


def _in_order(pdf: pd.DataFrame, order_by: Sequence[str]) -> pd.DataFrame:
    return pdf.sort_values(list(order_by), kind="stable", ignore_index=True)  # NaN last, as Spark sorts it


def _named(pdf: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    """The first columns under their own names; on the way here those that are no Python names were lost."""
    return pdf.iloc[:, : len(names)].set_axis(list(names), axis=1)


def _grouped(sdf: DataFrame, by: Sequence[str]):
    return sdf.groupBy(*[col(b) for b in by]) if by else sdf.withColumn(_ONE, F.lit(0)).groupBy(_ONE)


def _bucketed(sdf: DataFrame, by: Sequence[str], names: Sequence[str], alone: bool = False):
    """Grouped by bucket: the columns ``names``, the names of streams as text and the parts they share; as in any grouping, 0.0 and -0.0 are one.

    Columns are told apart by their places later on, so others, such as that of the watermark, come behind.
    """

    def text(name: str):
        c = col(name)
        return (c + F.lit(0.0) if isinstance(sdf.schema[name].dataType, (T.FloatType, T.DoubleType)) else c).cast("string")

    key = F.to_json(F.array(*[text(b) for b in by])) if by else F.lit("")
    hashed = F.xxhash64(_KEY)
    part = F.col(_KEY) if alone else F.pmod(F.shiftright(hashed, 32), F.lit(PARTS)).cast("string")
    out = sdf.withColumn(_KEY, key).withColumns({_PART: part, _BUCKET: F.pmod(hashed, F.lit(BUCKETS)).cast("int")})
    first = [*names, _KEY, _PART]
    return out.select(*[col(c) for c in [*first, *[c for c in out.columns if c not in first]]]).groupBy(_BUCKET)


def _by_key(pdf: pd.DataFrame, order_by: Sequence[str]) -> tuple[pd.DataFrame, list[str], np.ndarray]:
    """The rows stream by stream, each in order; the streams, and where the rows of each end."""
    pdf = _in_order(pdf, order_by)
    codes, keys = pd.factorize(pdf[_KEY])
    pdf = pdf.iloc[np.argsort(codes, kind="stable")].reset_index(drop=True)
    return pdf, list(keys), np.cumsum(np.bincount(codes, minlength=len(keys)))


def _by_part(pdf: pd.DataFrame, parts: Sequence[str]) -> Iterator[tuple[str, bytes]]:
    """The rows of each part, packed; ``parts`` has that of each row."""
    codes, names = pd.factorize(np.asarray(parts, object))
    pdf = pdf.iloc[np.argsort(codes, kind="stable")]
    return zip(names, _packed_parts(pdf, np.cumsum(np.bincount(codes, minlength=len(names)))))


def _with_nan(df: DataFrame) -> DataFrame:
    """Records hold no nulls, but pandas hands NaN over as null: put it back."""

    def restored(f: T.StructField):
        nan = lambda x, t: F.coalesce(x, F.lit(float("nan")).cast(t))
        floats = (T.FloatType, T.DoubleType)
        if isinstance(f.dataType, floats):
            return nan(col(f.name), f.dataType).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, floats):
            return F.transform(col(f.name), lambda x: nan(x, f.dataType.elementType)).alias(f.name)
        return col(f.name)

    return df.select(*[restored(f) for f in df.schema])


def _with(schema: T.StructType, fields: str) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], *T.StructType.fromDDL(fields).fields])


# ---- the latest records ------------------------------------------------------------------


class _Latest(StatefulProcessor):
    def __init__(self, n: int, order_by: list[str], names: list[str]):
        self.n, self.order_by, self.names = n, order_by, names

    def init(self, handle) -> None:
        self.kept = handle.getMapState("kept", "part string", "rows binary, totals binary")

    def _last(self, pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[str], np.ndarray]:
        pdf, keys, ends = _by_key(pdf, self.order_by)
        sizes = np.diff(ends, prepend=0)
        pdf = pdf[np.repeat(ends, sizes) - np.arange(len(pdf)) <= self.n]
        return pdf, keys, np.cumsum(np.minimum(sizes, self.n))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, came = None, {}
        for pdf in rows:
            pdf = _named(pdf, [*self.names, _MORE, _KEY, _PART])
            more = pdf.pop(_MORE) + 1
            for k, count in more.groupby(pdf[_KEY], sort=False).sum().items():
                came[k] = came.get(k, 0) + int(count)
            new = self._last(pdf if new is None else pd.concat([new, pdf], ignore_index=True))[0]
        totals = dict(came)
        before = [v for p in new[_PART].unique() if (v := self.kept.getValue((p,))) is not None]
        if before:  # what was kept comes first, so that it stays first among equals
            new = pd.concat([_unpacked(*[bytes(v[0]) for v in before]), new], ignore_index=True)
            for k, total in _unpacked(*[bytes(v[1]) for v in before]).itertuples(index=False):
                totals[k] = total + came.get(k, 0)
        new, keys, ends = self._last(new)
        sizes = np.diff(ends, prepend=0)
        held = pd.DataFrame({"key": keys, "total": [totals[k] for k in keys]})
        parts = new[_PART].to_numpy()
        for (part, data), (_, counted) in zip(_by_part(new, parts), _by_part(held, parts[ends - 1])):
            self.kept.updateValue((part,), (data, counted))
        seq = np.repeat(held["total"].to_numpy() - ends, sizes) + np.arange(len(new))
        own = np.repeat([k in came for k in keys], sizes)  # others only share a part
        yield new.drop(columns=[_KEY, _PART]).assign(seq=seq)[own]

    def close(self) -> None:
        pass


def _tails(n: int, order_by: list[str], by: list[str]):
    """Drop before the shuffle what cannot be among the last ``n`` of its stream, and say with the stream's first row how many that were."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[_MORE] = 0
            if len(pdf) > n:
                pdf = _in_order(pdf, order_by)
                groups = pdf.groupby(by, dropna=False, sort=False)
                back = groups.cumcount(ascending=False)
                pdf[_MORE] = np.where(back == np.minimum(n, groups[_MORE].transform("size")) - 1, (groups[_MORE].transform("size") - n).clip(lower=0), 0)
                pdf = pdf[back < n]
            yield pdf

    return run


def latest_records(sdf: DataFrame, n: int, by: str | Sequence[str], order_by: str | Sequence[str] = TIME_FIELD) -> DataFrame:
    """The last ``n`` records of each stream that a micro-batch has records of, with their positions ``seq``: a streaming DataFrame for update mode.

    Late records find their place by the order columns.  A task sends at most ``n`` records of a stream per Arrow batch to the shuffle.
    """
    if n < 1:
        raise ValueError("at least one record is kept")
    by, order_by = as_list(by), as_list(order_by)
    names = sdf.columns
    counted = sdf.mapInPandas(_tails(n, order_by, by), _with(sdf.schema, f"{_MORE} long"))
    grouped = _bucketed(counted, by, [*names, _MORE], n > FEW)
    return _with_nan(grouped.transformWithStateInPandas(_Latest(n, order_by, names), _with(sdf.schema, "seq long"), "Update", "None"))


# ---- running statistics ------------------------------------------------------------------


class _Running(StatefulProcessor):
    def __init__(self, field: str, order_by: list[str], names: list[str]):
        self.field, self.order_by, self.names = field, order_by, names

    def init(self, handle) -> None:
        self.handle = handle
        self.pieces = handle.getValueState("pieces", "starts binary, next long")
        self.pending = handle.getMapState("pending", "piece long", "rows binary")
        self.so_far = handle.getMapState("so_far", "part string", "sums binary")

    def _pieces(self) -> tuple[np.ndarray, int]:
        """The least time and the number of each piece of waiting records; the next number."""
        data, number = self.pieces.get() if self.pieces.exists() else (b"", 0)
        return np.frombuffer(bytes(data), np.int64).reshape(-1, 2), number

    def _wait(self, pdf: pd.DataFrame, pieces: np.ndarray, number: int) -> None:
        """Keep records in pieces of a span of time each, so that those far from ready are not read to find those that are."""
        pdf = pdf.sort_values(_WHEN, kind="stable", ignore_index=True)
        starts = np.arange(0, len(pdf), PIECE)
        added = np.stack([pdf[_WHEN].to_numpy(np.int64)[starts], number + np.arange(len(starts))], 1)
        for (least, i), data in zip(added.tolist(), _packed_parts(pdf, [*starts[1:], len(pdf)])):
            self.pending.updateValue((i,), (data,))
            self.handle.registerTimer(max(1, -(-least // 1000)))
        self.pieces.update((np.concatenate([pieces, added]).tobytes(), number + len(added)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([_named(pdf, [*self.names, _WHEN, _KEY, _PART]) for pdf in rows], ignore_index=True)
        self._wait(new, *self._pieces())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        pieces, number = self._pieces()
        due = pieces[:, 0] <= upto
        if not due.any():  # another timer of this micro-batch has seen to them
            return
        read = np.sort(pieces[due, 1]).tolist()  # in the order they came
        held = _unpacked(*[bytes(self.pending.getValue((i,))[0]) for i in read])
        for i in read:
            self.pending.removeKey((i,))
        ready = held[_WHEN] <= upto
        self._wait_or_end(held[~ready], pieces[~due], number)
        yield self._counted(held[ready].drop(columns=_WHEN))

    def _wait_or_end(self, rest: pd.DataFrame, pieces: np.ndarray, number: int) -> None:
        if len(rest):
            self._wait(rest, pieces, number)
        elif len(pieces):
            self.pieces.update((pieces.tobytes(), number))
        else:
            self.pieces.clear()

    def _counted(self, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, keys, ends = _by_key(pdf, self.order_by)
        part_of = dict(zip(keys, pdf[_PART].to_numpy()[ends - 1]))
        totals = {}
        for part in dict.fromkeys(part_of.values()):
            before = self.so_far.getValue((part,))
            if before is not None:
                for k, *held in _unpacked(bytes(before[0])).itertuples(index=False):
                    totals[k] = held
                    part_of[k] = part
        x = pdf[self.field].to_numpy(np.float64)
        counts = np.empty(len(x), np.int64)
        sums, least, most = np.empty_like(x), np.empty_like(x), np.empty_like(x)
        start = 0
        for k, end in zip(keys, ends.tolist()):
            n, s, lo, hi = totals.get(k, (0, 0.0, math.inf, -math.inf))
            own = slice(start, end)
            counts[own] = n + np.arange(1, end - start + 1)
            sums[own] = np.cumsum(np.append(s, x[own]))[1:]
            least[own], most[own] = np.fmin.accumulate(np.append(lo, x[own]))[1:], np.fmax.accumulate(np.append(hi, x[own]))[1:]
            totals[k] = int(counts[end - 1]), float(sums[end - 1]), float(least[end - 1]), float(most[end - 1])
            start = end
        held = pd.DataFrame([(k, *t) for k, t in totals.items()], columns=["key", "n", "s", "lo", "hi"])
        for part, data in _by_part(held, [part_of[k] for k in totals]):
            self.so_far.updateValue((part,), (data,))
        return pdf.drop(columns=[_KEY, _PART]).assign(count=counts, mean=sums / counts, min=least, max=most)

    def close(self) -> None:
        pass


def running_records(
    sdf: DataFrame, field: str, delay: str, by: str | Sequence[str] | None = None, order_by: str | Sequence[str] = TIME_FIELD
) -> DataFrame:
    """Each record with count, mean, min and max of ``field`` over its stream up to it: live ``stats.running_stats``, for append mode.

    A record waits until the watermark, ``delay`` behind the latest time, has passed it, so that records leave in order whatever order they came in;
    those later than that are dropped, and so are times before 1970, where watermarks start.  State per stream is four numbers and the
    records that wait; a micro-batch reads and writes the numbers of all streams of a part at once.
    """
    by, order_by = as_list(by), as_list(order_by)
    when = micros(col(TIME_FIELD))
    timed = sdf.withColumn(_WHEN, when).withColumn("__ts", F.timestamp_micros(_WHEN)).withWatermark("__ts", delay)
    schema = _with(sdf.schema, "count long, mean double, min double, max double")
    return _with_nan(_bucketed(timed, by, [*sdf.columns, _WHEN]).transformWithStateInPandas(_Running(field, order_by, sdf.columns), schema, "Append", "EventTime"))


# ---- batches of n ------------------------------------------------------------------------


class _Batches(StatefulProcessor):
    def __init__(self, n: int, order_by: list[str], names: list[str], partial: bool):
        self.n, self.order_by, self.names, self.partial = n, order_by, names, partial

    def init(self, handle) -> None:
        self.left = handle.getValueState("left", "rows binary, batch long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _in_order(pd.concat([_named(pdf, self.names) for pdf in rows], ignore_index=True), self.order_by)
        batch = 0
        if self.left.exists():
            data, batch = self.left.get()
            new = pd.concat([_unpacked(data), new], ignore_index=True)
        seq = batch * self.n + np.arange(len(new))
        whole = len(new) // self.n
        self.left.update((_packed(new.iloc[whole * self.n :]), batch + whole))
        out = new.assign(seq=seq, batch=seq // self.n)
        yield out if self.partial else out.iloc[: whole * self.n]

    def close(self) -> None:
        pass


def record_batches(
    sdf: DataFrame, n: int, order_by: str | Sequence[str] = TIME_FIELD, by: str | Sequence[str] | None = None, partial: bool = False
) -> DataFrame:
    """Batches of exactly ``n`` records of each stream, whatever the micro-batches hold: every record with ``seq`` and ``batch``, for update mode.

    What is left of a micro-batch waits for the next one.  With ``partial`` the records of the unfinished batch are handed out too,
    each time anew, so that a result kept by batch is up to date.  Records are ordered inside a micro-batch and follow those of the
    one before; a stream's records of one micro-batch meet in one task.
    """
    if n < 1:
        raise ValueError("a batch holds at least one record")
    order_by, by = as_list(order_by), as_list(by)
    processor = _Batches(n, order_by, sdf.columns, partial)
    return _with_nan(_grouped(sdf, by).transformWithStateInPandas(processor, _with(sdf.schema, "seq long, batch long"), "Update", "None"))
