"""Statistics over record streams: per field, per batch, running, rate, visible range."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.fields import array_channels, channel_list, in_range
from ..plans.ranges import BUCKET, SAMPLE_ROWS, add_range, col, key_ranges, literal_array, sample_for_sketch
from ..schema import TIME_FIELD, is_array, is_numeric
from .ordering import (
    MAX_GROUP_ROWS,
    STREAM,
    as_list,
    batches,
    earlier_ranges,
    stream_key,
    stream_sizes,
)

NAN = float("nan")


def _fields(df: DataFrame, fields: Sequence[str] | None, skip: Sequence[str]) -> list[T.StructField]:
    if fields is not None:
        return [df.schema[f] for f in fields]
    return [f for f in df.schema if is_numeric(f) and f.name not in skip]


def _nan_wins(agg: Column, any_nan: Column) -> Column:
    """Array-library min/max: NaN if any value is NaN (Spark's ``min`` passes over it)."""
    return F.when(any_nan, F.lit(NAN)).otherwise(agg)


def _parts(f: T.StructField) -> dict[str, Column]:
    """Mergeable aggregates of one field; array elements are folded inside the row."""
    c = col(f.name)
    if not is_array(f):
        x = c.cast("double")
        return {"n": F.count(x), "s": F.sum(x), "lo": F.min(x), "hi": F.max(x), "nan": F.max(F.isnan(x))}
    xs = F.filter(c.cast("array<double>"), lambda x: x.isNotNull())  # a null element is no value
    return {
        "n": F.sum(F.size(xs)).cast("long"),
        "s": F.sum(F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)),
        "lo": F.min(F.array_min(xs)),
        "hi": F.max(F.array_max(xs)),
        "nan": F.max(F.exists(xs, F.isnan)),
    }


def field_stats(df: DataFrame, by: str | Sequence[str] | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, min and max of each numeric field: ``[by..., field, count, mean, min, max]``.

    All fields are aggregated in one pass, arrays over all their elements.
    """
    by = as_list(by)
    used = _fields(df, fields, by)
    aggs = [a.alias(f"{part}{i}") for i, f in enumerate(used) for part, a in _parts(f).items()]
    wide = df.groupBy(*[col(b) for b in by]).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"),
                F.col(f"n{i}").alias("count"),
                (F.col(f"s{i}") / F.nullif(F.col(f"n{i}"), F.lit(0))).alias("mean"),
                _nan_wins(F.col(f"lo{i}"), F.col(f"nan{i}")).alias("min"),
                _nan_wins(F.col(f"hi{i}"), F.col(f"nan{i}")).alias("max"),
            )
            for i, f in enumerate(used)
        ]
    )
    return wide.select(*[col(b) for b in by], F.inline(rows))


QUARTILES = (0.25, 0.5, 0.75)


def describe(
    df: DataFrame,
    fields: Sequence[str] | None = None,
    quantiles: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Count, mean, sample deviation, min, exact quantiles (linear) and max of each field.

    ``[field, count, mean, std, min, p25, p50, p75, max]``; NaN counts as missing.  Spark's
    ``percentile`` keeps all distinct values of a field in one task.  Here a field of more than
    ``max_group_rows`` values is searched in ever narrower brackets around each quantile, and
    only the values in the last bracket are ranked.
    """
    used = [f for f in _fields(df, fields, ()) if not is_array(f)]
    doubles = {f.name: col(f.name).cast("double") for f in used}
    df = df.select(*[F.when(~F.isnan(x), x).alias(n) for n, x in doubles.items()])
    aggs = [
        agg(col(name)).alias(f"{agg.__name__}{i}")
        for i, name in enumerate(df.columns)
        for agg in (F.count, F.avg, F.stddev_samp, F.min, F.max)
    ]
    basic = df.agg(*aggs).first()

    spots = {(n, p): p * (basic[f"count{i}"] - 1) for i, n in enumerate(df.columns) if basic[f"count{i}"] for p in quantiles}
    brackets = {(n, p): (n, basic[f"min{i}"], basic[f"max{i}"]) for i, n in enumerate(df.columns) for p in quantiles}
    brackets = {key: brackets[key] for key in spots}
    values = _ranked(df, {key: (floor(s), ceil(s)) for key, s in spots.items()}, brackets, accuracy, max_group_rows)

    rows = []
    for i, name in enumerate(df.columns):
        marks = []
        for p in quantiles:
            spot = spots.get((name, p))
            a, b = (None, None) if spot is None else (values[name, floor(spot)], values[name, ceil(spot)])
            marks.append(None if spot is None else a + (b - a) * (spot - floor(spot)))
        rows.append((name, basic[f"count{i}"], basic[f"avg{i}"], basic[f"stddev_samp{i}"], basic[f"min{i}"], *marks, basic[f"max{i}"]))
    names = ["mean", "std", "min", *[f"p{round(p * 100):d}" for p in quantiles], "max"]
    return df.sparkSession.createDataFrame(rows, "field string, count long, " + ", ".join(f"{c} double" for c in names))


def _ranked(
    df: DataFrame, ranks: dict, brackets: dict, accuracy: int, max_group_rows: int, slack: float | None = None
) -> dict[tuple[str, int], float]:
    """Values at ranks, looked for inside each quantile's bracket: ``{(column, rank): value}``.

    A bracket that holds many rows is narrowed by a sketch first, with ``slack`` on both sides
    for its error.  A rank that ended up outside is looked for again with more slack.
    """
    spans = sorted(set(brackets.values()))
    if not spans:
        return {}
    slack = slack or 3 / accuracy + 2 / sqrt(SAMPLE_ROWS)  # of the sketch, and four deviations of the sample
    inside = [col(n).between(lo, hi) for n, lo, hi in spans]
    below = df.agg(
        *[F.count_if(col(n) < lo).alias(f"b{j}") for j, (n, lo, _) in enumerate(spans)],
        *[F.count_if(hit).alias(f"n{j}") for j, hit in enumerate(inside)],
    ).first()

    held = {key: below[f"n{spans.index(span)}"] for key, span in brackets.items()}
    wide = [key for key, n in held.items() if n > max_group_rows]
    if wide:
        sample = sample_for_sketch(df, min(held[key] for key in wide), seed=len(spans))
        sketches = []
        for i, key in enumerate(wide):
            j = spans.index(brackets[key])
            at = [(r - below[f"b{j}"]) / below[f"n{j}"] for r in ranks[key]]
            grid = [min(1.0, max(0.0, x)) for x in (min(at) - slack, max(at) + slack)]
            sketches.append(F.percentile_approx(F.when(inside[j], col(key[0])), literal_array(grid, "double"), F.lit(accuracy)).alias(f"q{i}"))
        found = sample.agg(*sketches).first()
        narrow = brackets | {key: (key[0], *(found[f"q{i}"] or brackets[key][1:])) for i, key in enumerate(wide)}
        if narrow != brackets:
            return _ranked(df, ranks, narrow, accuracy, max_group_rows, slack)

    cells = df.where(reduce(Column.__or__, inside)).select(
        F.explode(F.array(*[F.when(hit, F.struct(F.lit(j).alias("j"), col(n).alias("v"))) for j, (hit, (n, _, _)) in enumerate(zip(inside, spans))])).alias("x")
    )
    wanted = [sorted({r for key, rs in ranks.items() if brackets[key] == s for r in rs}) for s in spans]
    here = F.get(F.array(*[literal_array(w, "bigint") for w in wanted]), F.col("j"))
    start = F.get(literal_array([below[f"b{j}"] for j in range(len(spans))], "bigint"), F.col("j"))
    upto = Window.partitionBy("j").orderBy("v")
    found = (
        cells.where(F.col("x").isNotNull())
        .groupBy("x.j", "x.v")  # equal values are counted before they are shuffled
        .count()
        .withColumn("end", F.sum("count").over(upto) + start)
        .select("j", "v", F.explode(F.filter(here, lambda r: (r >= F.col("end") - F.col("count")) & (r < F.col("end")))).alias("r"))
        .collect()
    )
    values = {(spans[r["j"]][0], r["r"]): r["v"] for r in found}
    lost = {key: rs for key, rs in ranks.items() if any((key[0], r) not in values for r in rs)}
    if lost:
        whole = {key: (key[0], float("-inf"), float("inf")) for key in lost}
        if slack >= 1:
            raise RuntimeError(f"the rows changed between passes: no value at {lost}")
        values |= _ranked(df, lost, whole, accuracy, max_group_rows, slack * 4)
    return values


def batch_stats(df: DataFrame, n: int, field: str, order_by=TIME_FIELD, by=None, **opts) -> DataFrame:
    """Per ``n``-record batch: ``[by..., batch, count, total, mean, std]``.

    ``total`` counts the records up to the end of the batch; ``std`` is the population
    deviation.
    """
    by = as_list(by)
    narrow = df.select(*[col(c) for c in dict.fromkeys([*by, *as_list(order_by), field])])
    x = col(field).cast("double")
    return (
        batches(narrow, n, order_by, by, **opts)
        .groupBy(*[col(b) for b in by], "batch")
        .agg(F.count(F.lit(1)).alias("count"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
        .select(
            *[col(b) for b in by], "batch", "count",
            (F.col("batch") * n + F.col("count")).alias("total"), "mean", "std",
        )
    )


def _running_parts(x: Column) -> dict[str, Column]:
    solid = F.when(~F.isnan(x), x)
    return {"n": F.count(x), "s": F.sum(x), "lo": F.min(solid), "hi": F.max(solid)}


def _running_columns(n: Column, s: Column, lo: Column, hi: Column) -> list[Column]:
    """Count, mean, min and max so far; zeros while nothing has been seen.

    Min and max pass over NaN, so they stay at their infinities while there is nothing else.
    """
    empty = n == 0
    return [
        n.alias("count"),
        F.when(empty, 0.0).otherwise(s / F.nullif(n, F.lit(0))).alias("mean"),
        F.when(empty, 0.0).otherwise(F.coalesce(lo, F.lit(float("inf")))).alias("min"),
        F.when(empty, 0.0).otherwise(F.coalesce(hi, F.lit(float("-inf")))).alias("max"),
    ]


def running_stats(
    df: DataFrame,
    field: str,
    order_by: str | Sequence[str] = TIME_FIELD,
    by: str | Sequence[str] | None = None,
    n_ranges: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add count, mean, min and max of ``field`` over each stream so far, to every record."""
    order_by, by = as_list(order_by), as_list(by)
    order = [col(c) for c in order_by]
    parts = _running_parts(col(field).cast("double"))
    so_far = (Window.unboundedPreceding, Window.currentRow)

    largest, total = stream_sizes(df, by) if by else (None, None)
    if by and largest <= max_group_rows:
        w = Window.partitionBy(*[col(b) for b in by]).orderBy(*order).rowsBetween(*so_far)
        return df.select("*", *_running_columns(**{k: a.over(w) for k, a in parts.items()}))

    ranges = key_ranges(df, order_by, n_ranges, total)
    keyed = add_range(df.withColumn(STREAM, stream_key(by) if by else F.lit(0)), ranges)
    w = Window.partitionBy(STREAM, BUCKET).orderBy(*order).rowsBetween(*so_far)
    earlier = earlier_ranges(
        keyed, [a.alias(f"__{k}") for k, a in parts.items()],
        {"__n": F.sum, "__s": F.sum, "__lo": F.min, "__hi": F.max},
    )
    here = keyed.select("*", *[a.over(w).alias(f"__r{k}") for k, a in parts.items()])
    joined = here.join(earlier, [STREAM, BUCKET])
    merged = {
        "n": F.col("__rn") + F.coalesce("__n", F.lit(0)),
        "s": F.coalesce(F.col("__rs") + F.col("__s"), F.col("__rs"), F.col("__s")),
        "lo": F.least("__rlo", "__lo"),  # least and greatest pass over nulls
        "hi": F.greatest("__rhi", "__hi"),
    }
    return joined.select(*[col(c) for c in df.columns], *_running_columns(**merged))


def running_summary(df: DataFrame, field: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """The running statistics after the last record; also for streaming input.

    Order does not matter here, so it is a plain aggregate.  Without ``by`` an empty input
    gives one row of zeros.
    """
    by = as_list(by)
    parts = _running_parts(col(field).cast("double"))
    out = df.groupBy(*[col(b) for b in by]).agg(*[a.alias(f"__{k}") for k, a in parts.items()])
    return out.select(*[col(b) for b in by], *_running_columns(**{k: F.col(f"__{k}") for k in parts}))


def micros(time: Column) -> Column:
    """A record time in whole microseconds."""
    return F.round(time * 1e6).cast("long")


def interval_micros(seconds: float) -> int:
    """The length of an interval in microseconds, which it must fill exactly or nearly so."""
    width = round(seconds * 1e6)
    if width < 1:
        raise ValueError(f"an interval lasts at least a microsecond, not {seconds} s")
    return width


def rate(df: DataFrame, seconds: float, by: str | Sequence[str] | None = None) -> DataFrame:
    """Records per second in tumbling event-time intervals: ``[by..., TimeStamp, count, rate]``.

    ``TimeStamp`` is the start of the interval.  Times and intervals are counted in whole microseconds, as the live rate
    counts them.  Intervals without records have no row.
    """
    by, width = as_list(by), F.lit(interval_micros(seconds))
    start = micros(col(TIME_FIELD)) - F.pmod(micros(col(TIME_FIELD)), width)
    return (
        df.groupBy(*[col(b) for b in by], start.alias("__start"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(*[col(b) for b in by], (F.col("__start") / F.lit(1e6)).alias(TIME_FIELD), "count", (F.col("count") / F.lit(float(seconds))).alias("rate"))
    )


# Padding of a fitted range, as a share of its span or of a flat value.
PAD_SHARE = 0.05
PAD_AT_ZERO = 1.0


def visible_range(df: DataFrame, lo, hi, on: str = TIME_FIELD, skip: Sequence[str] = ()) -> DataFrame:
    """Padded min and max of each analog channel over the records in ``[lo, hi]``.

    ``[channel, y_min, y_max]``; no records in range, no rows.  Plain fields stay columns until one row is left; the elements
    of array fields become rows, so a plan is as large for two elements as for two thousand.
    """
    df = in_range(df, lo, hi, on)
    tracks = [t for t in channel_list(df.schema, skip) if not t.digital]
    parts = []
    if tracks:
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, t in enumerate(tracks):
            y = t.value.cast("double")
            aggs += [F.min(y).alias(f"lo{i}"), F.max(y).alias(f"hi{i}"), F.max(F.isnan(y)).alias(f"nan{i}")]
        one = df.agg(*aggs).where(F.col("__n") > 0)
        fitted = [
            F.struct(
                F.lit(t.name).alias("channel"),
                _nan_wins(F.col(f"lo{i}"), F.col(f"nan{i}")).alias("lo"),
                _nan_wins(F.col(f"hi{i}"), F.col(f"nan{i}")).alias("hi"),
            )
            for i, t in enumerate(tracks)
        ]
        parts.append(one.select(F.inline(F.array(*fitted))))
    arrays = [f for f in df.schema if f.name not in skip and is_numeric(f) and is_array(f)]
    if arrays:
        elements = df.select(F.inline(F.concat(*[array_channels(f) for f in arrays])))
        y = F.col("y")
        each = elements.groupBy("field", "index").agg(F.min(y).alias("lo"), F.max(y).alias("hi"), F.max(F.isnan(y)).alias("nan"))
        name = F.concat("field", F.lit("["), F.col("index").cast("string"), F.lit("]"))
        parts.append(each.select(name.alias("channel"), _nan_wins(F.col("lo"), F.col("nan")).alias("lo"), _nan_wins(F.col("hi"), F.col("nan")).alias("hi")))
    if not parts:
        raise ValueError("no numeric field to fit")
    rows = reduce(DataFrame.union, parts)
    pad = (
        F.when(F.col("lo") != F.col("hi"), (F.col("hi") - F.col("lo")) * PAD_SHARE)
        .when(F.col("lo") == 0.0, PAD_AT_ZERO)
        .otherwise(F.abs("lo") * PAD_SHARE)
    )
    return rows.select("channel", (F.col("lo") - pad).alias("y_min"), (F.col("hi") + pad).alias("y_max"))
