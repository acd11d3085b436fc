"""How much a stream holds, and how far its consumers are behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans.ranges import col
from .ordering import STREAM, as_list, stream_key


def stream_status(df: DataFrame, capacity: int, by: str | Sequence[str] = "stream", streams: DataFrame | None = None) -> DataFrame:
    """Per stream: records ever written, those kept by a buffer of ``capacity``, those overwritten.

    ``streams`` names all streams there are, such as the catalog's; those without records then have a row too.
    """
    names = [col(b) for b in as_list(by)]
    kept = F.least(F.col("total_written"), F.lit(capacity).cast("long"))
    written = df.groupBy(*names).agg(F.count(F.lit(1)).alias("total_written"))
    if streams is not None:
        empty = streams.select(*names, F.lit(0).cast("long").alias("total_written"))
        written = written.unionByName(empty).groupBy(*names).agg(F.sum("total_written").alias("total_written"))
    return (
        written.withColumn("capacity", F.lit(capacity).cast("long"))
        .withColumn("size", kept)
        .withColumn("overwritten", F.col("total_written") - kept)
    )


def consumer_lag(status: DataFrame, cursors: DataFrame, by: str | Sequence[str] = "stream") -> DataFrame:
    """Each consumer's distance from the end of its stream: the cursor columns plus ``lag``.

    A null cursor marks a passive consumer; its lag is null.  A stream that ``status`` does not list has no records, and a
    null name is a stream like any other.
    """
    by = as_list(by)
    ends = status.select(stream_key(by).alias(STREAM), "total_written")
    end = F.coalesce("total_written", F.lit(0).cast("long"))
    return cursors.withColumn(STREAM, stream_key(by)).join(ends, STREAM, "left").select(*[col(c) for c in cursors.columns], (end - F.col("cursor")).alias("lag"))


def write_space(status: DataFrame, cursors: DataFrame, by: str | Sequence[str] = "stream") -> DataFrame:
    """Per stream: ``[by..., max_lag, free]``, the room left before the slowest active consumer.

    Only the smallest cursor of a stream counts, so cursors are reduced before the join.
    """
    by = as_list(by)
    slowest = cursors.groupBy(stream_key(by).alias(STREAM)).agg(F.min("cursor").alias("__cursor"))
    lag = F.coalesce(F.col("total_written") - F.col("__cursor"), F.lit(0).cast("long"))
    return status.withColumn(STREAM, stream_key(by)).join(slowest, STREAM, "left").select(
        *[col(b) for b in by], lag.alias("max_lag"), F.greatest(F.col("capacity") - lag, F.lit(0).cast("long")).alias("free")
    )
