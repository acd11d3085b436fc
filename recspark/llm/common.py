"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..workspace import discard, written

#: White space of the contracts: blank and the five control characters from tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"


#: Edges in one file of a round of :func:`components`.
EDGES_PER_FILE = 50_000


def packed(df: DataFrame, row: str = "row") -> DataFrame:
    """All columns of ``df`` inside one struct, so that names of working columns cannot clash with them."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(row))


def kept(df: DataFrame, keep: tuple[str, ...] | None, row: str = "row", replaced: tuple[str, ...] = ()) -> Column:
    """The columns ``keep`` of ``df``, or all of them, as one struct; without those that new columns of these names replace."""
    gone = {c.lower() for c in replaced}
    names = [c for c in (df.columns if keep is None else keep) if c.lower() not in gone]
    return F.struct(*[df[f"`{c}`"] for c in names]).alias(row)


def unpacked(df: DataFrame, row: str = "row") -> DataFrame:
    return df.select(f"{row}.*")


def words_of(text: Column) -> Column:
    """The words of a text, split at white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def small_enough(df: DataFrame, row_bytes: int, limit: int = 64 << 20) -> bool:
    """Whether a written table may be sent to every executor: its rows are counted first, and the bytes of its texts."""
    texts = [F.sum(F.octet_length(F.col(f"`{f.name}`"))) for f in df.schema if isinstance(f.dataType, T.StringType)]
    rows, *lengths = df.agg(F.count(F.lit(1)), *texts).first()
    return rows * row_bytes + sum(n or 0 for n in lengths) <= limit


def sent(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written table, marked for broadcast if its counted size allows it and else left to a shuffled join."""
    return F.broadcast(df) if small_enough(df, row_bytes) else df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the edges ``a``, ``b``: rows ``node``, ``root``, the smallest node reachable.

    Large-star and small-star steps in turn (Kiveris and others, 2014): each ties a node's neighbours to the
    smallest of them, so depth shrinks with every round and a hub costs one row for each of its edges.  The
    smallest neighbours are written before they are joined, so a join on a hub splits like any skewed join.  Tables go into
    as many files as the number of edges asks for, since there are many rounds and often few edges.
    Nulls and loops tie nothing.  Only nodes that are not their own root are returned.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(most, -(-now.count() // EDGES_PER_FILE)) or 1

    def put(df: DataFrame, label: str) -> DataFrame:
        return written(df.coalesce(parts) if parts < most else df, label)

    for _ in range(rounds):
        if _settled(now, parts):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
        large = put(
            both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "stars"
        )
        discard(now, least)
        least = put(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = put(small.union(least.select("a", "m")).distinct(), "edges")
        discard(large, least)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _settled(edges: DataFrame, parts: int) -> bool:
    """Whether every node hangs on one root that hangs on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or up = 1 and down = 1").coalesce(parts).count() == 0
