"""Positions, batches, slices and the latest N records of a stream.

A stream's order is given by explicit columns, by default ``TimeStamp``; end the list with
a unique column so that equal timestamps have one order.  ``by`` names the columns that
tell streams apart.  Positions count from 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.ranges import BUCKET, KeyRanges, add_range, col, default_ranges, key_ranges, literal_array
from ..schema import TIME_FIELD

# A stream up to this many rows is ordered by one task (the sort spills); a larger one is cut
# into key ranges first.
MAX_GROUP_ROWS = 5_000_000

STREAM = "__stream"


def as_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def stream_key(by: Sequence[str]) -> Column:
    """One comparable key per stream; as a struct it also matches null names in joins."""
    return F.struct(*[col(b).alias(f"b{i}") for i, b in enumerate(by)])


def stream_sizes(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest stream, and of all streams.  Counts are combined map-side."""
    row = df.groupBy(*[col(b) for b in by]).count().agg(F.max("count"), F.sum("count")).first()
    return row[0] or 0, row[1] or 0


def range_counts(df: DataFrame, ranges: KeyRanges) -> list[int]:
    """Rows per range, one number each."""
    rows = add_range(df, ranges).groupBy(BUCKET).count().collect()
    counts = [0] * ranges.count
    for r in rows:
        counts[r[BUCKET]] = r["count"]
    return counts


def _positions_in_ranges(df: DataFrame, ranges: KeyRanges, starts: Sequence[int], seq: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Rows of the ranges ``first`` to ``last`` with their positions.

    Each range is one partition, in order, so partitions are as even as the ranges and rows come in order.
    """
    last = ranges.count - 1 if last is None else last
    w = Window.partitionBy(BUCKET).orderBy(*[col(c) for c in ranges.order_by])
    start = F.get(literal_array(starts[first : last + 1], "bigint"), F.col(BUCKET))
    return (
        add_range(df, ranges)
        .withColumn(BUCKET, F.col(BUCKET) - first)
        .repartitionById(max(2, last - first + 1), F.col(BUCKET))
        .withColumn(seq, F.row_number().over(w) - 1 + start)
        .drop(BUCKET)
    )


def _starts(counts: Sequence[int]) -> list[int]:
    out, total = [], 0
    for c in counts:
        out.append(total)
        total += c
    return out


def with_seq(
    df: DataFrame,
    order_by: str | Sequence[str] = TIME_FIELD,
    by: str | Sequence[str] | None = None,
    seq: str = "seq",
    n_ranges: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the 0-based position of each record in its stream.

    ``df`` is read more than once, so it must give the same rows each time.
    """
    order_by, by = as_list(order_by), as_list(by)
    if not by:
        ranges = key_ranges(df, order_by, n_ranges)
        return _positions_in_ranges(df, ranges, _starts(range_counts(df, ranges)), seq)

    order = [col(c) for c in order_by]
    largest, total = stream_sizes(df, by)
    if largest <= max_group_rows:
        w = Window.partitionBy(*[col(b) for b in by]).orderBy(*order)
        return df.withColumn(seq, (F.row_number().over(w) - 1).cast("long"))

    ranges = key_ranges(df, order_by, n_ranges, total)
    keyed = add_range(df.withColumn(STREAM, stream_key(by)), ranges)
    earlier = earlier_ranges(keyed, [F.count(F.lit(1)).alias("n")], {"n": F.sum})
    w = Window.partitionBy(STREAM, BUCKET).orderBy(*order)
    return (
        keyed.withColumn(seq, (F.row_number().over(w) - 1).cast("long"))
        .join(earlier, [STREAM, BUCKET])
        .withColumn(seq, F.col(seq) + F.coalesce("n", F.lit(0)))
        .select(*[col(c) for c in df.columns], col(seq))
    )


def earlier_ranges(keyed: DataFrame, aggs: Sequence[Column], merge: dict) -> DataFrame:
    """Per stream and range: the totals of that stream's earlier ranges (null in the first).

    At most one row per range and stream enters the window here.
    """
    before = Window.partitionBy(STREAM).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy(STREAM, BUCKET).agg(*aggs)
    return totals.select(STREAM, BUCKET, *[f(name).over(before).alias(name) for name, f in merge.items()])


def positions_between(
    df: DataFrame,
    lo: int,
    hi: int | None,
    order_by: str | Sequence[str] = TIME_FIELD,
    seq: str = "seq",
    n_ranges: int | None = None,
    from_end: bool = False,
) -> DataFrame:
    """Records at positions ``[lo, hi)`` of one stream, in order, ordering only the ranges they lie in.

    With ``from_end`` both bounds count back from the end of the stream.
    """
    ranges = key_ranges(df, as_list(order_by), n_ranges)
    counts = range_counts(df, ranges)
    starts, total = _starts(counts), sum(counts)
    if from_end:
        lo, hi = max(0, total - lo), total if hi is None else total - hi
    hi = total if hi is None else min(hi, total)
    lo = max(0, lo)
    hit = [i for i, (s, c) in enumerate(zip(starts, counts)) if c and s < hi and s + c > lo]
    if not hit or lo >= hi:
        return df.where(F.lit(False)).withColumn(seq, F.lit(0).cast("long"))
    part = df.where(ranges.within(hit[0], hit[-1]))
    return _positions_in_ranges(part, ranges, starts, seq, hit[0], hit[-1]).where(col(seq).between(lo, hi - 1))


def batches(df: DataFrame, n: int, order_by=TIME_FIELD, by=None, **opts) -> DataFrame:
    """Add ``seq`` and the number of the ``n``-record batch each record falls in."""
    if n < 1:
        raise ValueError("a batch holds at least one record")
    return with_seq(df, order_by, by, **opts).withColumn("batch", F.expr(f"seq div {int(n)}"))


def latest(
    df: DataFrame,
    n: int,
    order_by: str | Sequence[str] = TIME_FIELD,
    by: str | Sequence[str] | None = None,
    n_ranges: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The last ``n`` records of each stream with their position, oldest first."""
    order_by, by = as_list(order_by), as_list(by)
    if not by:
        return positions_between(df, n, None, order_by, n_ranges=n_ranges, from_end=True)

    slices = (n_ranges or default_ranges(df)) if stream_sizes(df, by)[0] > max_group_rows else 1
    totals = df.groupBy(stream_key(by).alias(STREAM)).agg(F.count(F.lit(1)).alias("__total"))
    return (
        newest(df, n, order_by, by, slices)
        .join(totals, STREAM)
        .withColumn("seq", F.col("__total") - F.col("__rank"))
        .select(*[col(c) for c in df.columns], "seq")
        .orderBy(*[col(b) for b in by], "seq")
    )


def newest(df: DataFrame, n: int, order_by: Sequence[str], by: Sequence[str], slices: int = 1) -> DataFrame:
    """The last ``n`` records of each stream, ranked from the newest (1) in ``__rank``.

    Tasks drop what cannot be among the last ``n`` before the shuffle, so a stream sends at
    most ``n`` records per task.  With ``slices`` the tasks' candidates are first ranked in that
    many groups of tasks, each of which leaves at most ``n``.
    """
    order = [col(c).desc() for c in order_by]
    out = df.withColumn(STREAM, stream_key(by))
    if slices > 1:
        part = F.pmod(F.spark_partition_id(), F.lit(slices))
        w = Window.partitionBy(STREAM, "__slice").orderBy(*order)
        out = out.withColumn("__slice", part).withColumn("__rank", F.row_number().over(w))
        out = out.where(F.col("__rank") <= n).drop("__slice", "__rank")
    w = Window.partitionBy(STREAM).orderBy(*order)
    return out.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n)


def slice_records(df: DataFrame, offset: int, count: int, order_by=TIME_FIELD, by=None, **opts) -> DataFrame:
    """Records at positions ``[offset, offset + count)``, in order."""
    if by:
        return with_seq(df, order_by, by, **opts).where(F.col("seq").between(offset, offset + count - 1)).orderBy(*[col(b) for b in as_list(by)], "seq")
    return positions_between(df, offset, offset + count, order_by, **opts)


def read_after(
    df: DataFrame, cursor: int, max_records: int | None = None, order_by=TIME_FIELD, by=None, **opts
) -> DataFrame:
    """Records from position ``cursor`` on, at most ``max_records`` of each stream, in order."""
    end = None if max_records is None else cursor + max_records
    if by:
        out = with_seq(df, order_by, by, **opts).where(F.col("seq") >= cursor)
        out = out if end is None else out.where(F.col("seq") < end)
        return out.orderBy(*[col(b) for b in as_list(by)], "seq")
    return positions_between(df, cursor, end, order_by, **opts)


def head(df: DataFrame, n: int = 5, order_by=TIME_FIELD) -> DataFrame:
    """The first ``n`` records in order."""
    return df.orderBy(*[col(c) for c in as_list(order_by)]).limit(n)


def concat(dfs: Sequence[DataFrame]) -> DataFrame:
    """One DataFrame from many with the same fields, matched by name."""
    return reduce(DataFrame.unionByName, dfs)
