"""Ordered work on one huge stream, split by key range.

Spark rows have no order, and a window without partitions pulls a whole stream into one
task.  Here the order key is cut into ranges of about equal row counts, as a sample sort does:

1. evenly spaced rows of a sorted sample become the cuts: whole keys, of all order columns in their own types;
2. the cuts become one literal, so every later pass puts a row into the same range;
3. work inside a range is an ordinary partitioned window, and per-range totals of the
   earlier ranges supply the rest.

Keys are compared column by column as a sort compares them, so a value that fills several ranges is cut by the columns after it, and
any type that can be sorted can be cut.  Cut points only decide balance: any set of cuts gives the same answer.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BUCKET = "__range"
MAX_RANGES = 20_000  # also bounds what is collected: one cut and one count per range
RANGE_ROWS = 1_000_000  # rows that a range holds on average, up to so many ranges
SAMPLE_ROWS = 2_000_000  # at most about this many rows feed a sketch or are sorted for the cuts, over all tasks
CUT_ROWS = 100  # sampled rows per range, where the stream is not small
SMALL_SAMPLE = 200_000  # a stream of up to so many rows is not sampled


def col(name: str) -> Column:
    """A column by its exact name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")


def literal_array(values: Sequence, element: str) -> Column:
    """A constant array; one literal however long, since Spark folds it when it plans."""
    if not values:
        return F.array().cast(f"array<{element}>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{element}>")


def default_ranges(df: DataFrame, total: int | None = None) -> int:
    """Ranges for ``total`` rows: by their number, and at least one for each shuffle partition."""
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MAX_RANGES, max(shuffles, -(-(total or 0) // RANGE_ROWS))))


def local_seconds(c: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, as an exact decimal.

    The difference of two such timestamps knows no time zone; functions that go through the
    session's zone are an hour off where its clock changes.
    """
    return (c - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("interval second").cast("decimal(18,6)")


#: Cuts travel as JSON, times to the microsecond.  What a type may lose that way moves a cut and nothing else.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _key(order_by: Sequence[str]) -> Column:
    """A row's whole key; such structs compare as the columns sort, nulls first."""
    return F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(order_by)])


@dataclass(frozen=True)
class KeyRanges:
    """Ascending cuts, each a key over all order columns."""

    order_by: tuple[str, ...]
    schema: T.StructType
    cuts: tuple[str, ...]

    @property
    def count(self) -> int:
        return len(self.cuts) + 1

    def points(self) -> Column:
        """The cuts as one constant array."""
        text = F.lit("[" + ",".join(self.cuts) + "]")
        return F.sort_array(F.from_json(text, T.ArrayType(self.schema), _JSON))

    def key(self) -> Column:
        return _key(self.order_by)

    def within(self, first: int, last: int) -> Column:
        """Rows of ranges ``first``..``last``; the leading column's bounds reach the scan."""
        cond = F.lit(True)
        if not self.cuts:
            return cond
        points, lead = self.points(), col(self.order_by[0])
        bound = lambda i: F.get(points, F.lit(i))["k0"]
        given = lambda i: json.loads(self.cuts[i]).get("k0") is not None
        no_nulls = first > 0 and given(first - 1)
        if first > 0:
            cond = cond & at_or_below(points, F.lit(first - 1), self.key())
            if no_nulls:
                cond = cond & (lead >= bound(first - 1))
        if last < len(self.cuts):
            cond = cond & ~at_or_below(points, F.lit(last), self.key())
            if given(last):
                upto = lead <= bound(last)
                cond = cond & (upto if no_nulls else upto | lead.isNull())
        return cond


def at_or_below(points: Column, i: Column, key: Column) -> Column:
    """Is cut ``i`` not above a row's key?"""
    return F.coalesce(F.get(points, i) <= key, F.lit(True))


def add_range(df: DataFrame, ranges: KeyRanges, name: str = BUCKET) -> DataFrame:
    """Add the range number of each row: how many cuts are not above its key.

    Each halving step of the binary search is a projection of its own, which keeps the search
    inside generated code; as one nested expression it would double in size with every step.
    """
    if not ranges.cuts:
        return df.withColumn(name, F.lit(0))
    out = df.select("*", F.lit(0).alias(name), ranges.key().alias("__key"))
    points, n, at = ranges.points(), len(ranges.cuts), F.col(name)
    step = 1 << n.bit_length() >> 1
    while step:
        up = (at <= n - step) & at_or_below(points, at + (step - 1), F.col("__key"))
        out = out.withColumn(name, at + F.when(up, F.lit(step)).otherwise(F.lit(0)))
        step >>= 1
    return out.drop("__key")


def sample_for_sketch(df: DataFrame, total: int, seed: int = 0, rows: int | None = None) -> DataFrame:
    """``df`` itself, or a random part of it if it is large.  For estimates only."""
    rows = SAMPLE_ROWS if rows is None else rows
    return df if total <= rows else df.sample(rows / total, seed)


def key_ranges(df: DataFrame, order_by: Sequence[str], n_ranges: int | None = None, total: int | None = None) -> KeyRanges:
    """Cut the order key of ``df`` (of ``total`` rows) into about ``n_ranges`` ranges of equal row counts.

    Rows that are equal in all order columns stay together in one range, so an order over much data should end
    with a column that tells rows apart.  Large inputs are sampled, some rows for each range; that moves the cuts and nothing else.
    """
    total = df.count() if total is None else total
    n = min(MAX_RANGES, n_ranges or default_ranges(df, total))
    key = _key(order_by)
    schema = df.select(key.alias("k")).schema["k"].dataType
    if n < 2 or total < 2:
        return KeyRanges(tuple(order_by), schema, ())
    rows = min(SAMPLE_ROWS, max(CUT_ROWS * n, SMALL_SAMPLE))
    sample = sample_for_sketch(df, total, rows=rows).select(key.alias("k"), F.lit(0).alias("one"))
    # one task sorts the sample, whose size is bounded, and cuts it into as many pieces
    pieces = sample.select("k", F.ntile(n).over(Window.partitionBy("one").orderBy("k")).alias("piece"))
    firsts = pieces.groupBy("piece").agg(F.min("k").alias("k")).where("piece > 1").select("k").distinct()
    cuts = firsts.agg(F.sort_array(F.collect_list("k")).alias("cuts")).select(F.transform("cuts", lambda k: F.to_json(k, _JSON)).alias("cuts"))
    return KeyRanges(tuple(order_by), schema, tuple(cuts.first()["cuts"]))
