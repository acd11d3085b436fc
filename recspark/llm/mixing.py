"""Mixing sources to target weights by Pareto order sampling (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import written
from .common import BLANK, packed, sent, words_of

#: No target, and so no document, is taken more than this many times over.
MAX_TIMES = 3
#: Weights of the sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: Rows that one rank interval holds on average; the interval in which a target ends is ranked row by row.
INTERVAL_ROWS = 4096


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts as the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_times: int = MAX_TIMES) -> DataFrame:
    """One row per ``source``: ``n``, ``source_size``, ``target``.

    Targets share the total size by weight.  Where one would pass ``max_times`` its source's size it stops there, and
    the rest goes to the others by weight, until none is above: so some level ``x`` gives each source the lesser of
    its stop and ``x`` times its weight.  Sources sorted by stop over weight fill up in that order, which finds ``x``.
    The two windows without a key run over one short row per source.
    """
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("source")) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int"))
    per = written(per.withColumn("weight", weight).withColumn("stop", F.lit(float(max_times)) * F.col("source_size")), "sources")
    total = float(per.agg(F.sum("source_size")).first()[0] or 0)
    order = Window.orderBy(F.col("stop") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(total) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = per.withColumn("level", level).where(F.col("stop") >= F.col("level") * F.col("weight"))
    x = levels.agg(F.min_by("level", F.struct(F.col("stop") / F.col("weight"), "source"))).first()[0]
    target = F.col("stop") if x is None else F.least("stop", F.lit(x) * F.col("weight"))
    return per.select("source", "n", "source_size", target.alias("target"))


def measure(size: Column) -> Column:
    """What the copies of a document are in proportion to: the root of its size, rounded up; whole, so that sums are exact."""
    return F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("long")


def shares(sized: DataFrame, per: DataFrame, max_times: int = MAX_TIMES) -> DataFrame:
    """``per`` (the rows of :func:`targets`) with ``x`` and ``need``.

    A document is expected ``least(max_times, x * measure)`` times, for that ``x`` at which the expected words of its source are
    the target; x is null where every document stops at ``max_times``.  Sizes are first summed by source and measure, of which there are few; large
    measures reach the stop first, so the ``x`` at the first one that stays below it holds.  ``need`` is the part of the target that whole copies leave.
    """
    names = [F.col("source").alias("_s"), F.col("target").alias("_t"), F.col("source_size").alias("_z")]
    groups = sized.groupBy("source", measure(F.col("size")).alias("m")).agg(F.sum("size").alias("words"))
    groups = written(groups.join(sent(per.select(*names), 96), F.col("source") == F.col("_s")).drop("_s"), "measures")
    order = Window.partitionBy("source").orderBy(F.col("m").desc())
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(F.col("words").cast("decimal(20,0)") * F.col("m")).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    top = float(max_times)
    x = F.try_divide(F.col("_t") - F.lit(top) * before.cast("double"), left.cast("double"))
    level = groups.withColumn("x", x).where(F.col("x") * F.col("m") <= top).groupBy("source").agg(F.max_by("x", "m").alias("x"))
    level = level.select(F.col("source").alias("_l"), "x")
    all_of = groups.join(level, F.col("source") == F.col("_l"), "left").drop("_l")
    whole = F.sum(F.col("words") * _whole(_expected(F.col("m"), F.col("_z"), top)))
    found = all_of.groupBy("source").agg(F.first("x").alias("x"), whole.alias("whole_words"))
    found = found.select(F.col("source").alias("_f"), "x", "whole_words")
    out = per.join(found, F.col("source") == F.col("_f")).drop("_f")
    return written(out.withColumn("need", F.col("target") - F.col("whole_words").cast("double")).drop("whole_words"), "shares")


def _expected(m: Column, source_size: Column, top: float) -> Column:
    """How often a document of a measure is expected in the mix."""
    return F.when(source_size > 0, F.coalesce(F.least(F.lit(top), F.col("x") * m), F.lit(top))).otherwise(F.lit(0.0))


def _whole(expected: Column) -> Column:
    return F.floor(expected + 1e-12)


def _uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a digest of the id; of the text where there is none."""
    own = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(text)))
    hex13 = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 13)
    return (F.conv(hex13, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def _order(part: Column) -> Column:
    """Pareto rank of a row, put between 0 and 1: random odds over inclusion odds, as odds/(1+odds)."""
    u = F.col("u")
    q = (u / (1 - u)) / (part / (1 - part))
    return F.when((part > 0) & (part < 1), q / (1 + q)).otherwise(u)


def _placed(sized: DataFrame, per: DataFrame, max_times: int = MAX_TIMES) -> DataFrame:
    """``sized`` with its source's figures: ``whole`` certain copies, the inclusion share ``part`` of one more, the rank ``q``.

    The sample ends near the rank at which random and inclusion odds are equal, in the middle.  There a rank interval holds no more of the
    documents than its width, whatever their shares are.
    """
    out = sized.join(sent(per.withColumnRenamed("source", "_s"), 96), F.col("source") == F.col("_s")).drop("_s")
    out = out.withColumn("expected", _expected(measure(F.col("size")), F.col("source_size"), float(max_times)))
    out = out.withColumn("whole", _whole(F.col("expected"))).withColumn("part", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
    cells = F.greatest(F.ceil(F.col("n") / INTERVAL_ROWS), F.lit(1))
    return out.withColumn("q", _order(F.col("part"))).withColumn("cell", F.least(F.floor(F.col("q") * cells), cells - 1))


def cutoffs(sized: DataFrame, per: DataFrame) -> DataFrame:
    """One row per source: the figures of ``shares`` and the last row (``cq``, ``cid``, ``csize``, ``ctie``) that gets one more copy.

    Ranked rows are taken until their sizes are as near as whole rows come to what the target still needs.  Sizes are
    first summed by source and rank interval; only the interval where the sum passes the need is ranked row by row.
    """
    placed = _placed(sized, per).where("part > 0")
    need = F.col("need")
    cells = placed.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
    first = (
        cells.withColumn("so_far", so_far).withColumn("before", F.col("so_far") - F.col("words"))
        .where((F.col("before") < need) & (F.col("so_far") >= need))
        .select("source", "cell", "before")
    )
    first = written(first, "cells")
    ranked = placed.join(sent(first.select(F.col("source").alias("_s"), F.col("cell").alias("_c"), "before"), 96), (F.col("source") == F.col("_s")) & (F.col("cell") == F.col("_c")))
    order = Window.partitionBy("source").orderBy(*KEY)
    upto = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("upto", upto)
    # half of the row lies inside the need: with it the sum is nearer than without
    taken = ranked.where(F.col("upto") - F.col("size") / 2 <= need)
    last = taken.groupBy("source").agg(F.max(F.struct(*KEY)).alias("last"))
    start = first.select(F.col("source").alias("_s"), F.col("cell").alias("_c"))
    out = per.join(start, per["source"] == start["_s"], "left").drop("_s").join(last, "source", "left")
    return written(out, "cutoffs")


KEY = ["q", "doc_id", "size", "tie"]


def _copies(placed: DataFrame) -> Column:
    """Whole copies and one more up to the cutoff: rows of earlier intervals, and in the last one those up to its last row."""
    mine = F.struct(*[F.col(c) for c in KEY])
    in_last = (F.col("cell") == F.col("_c")) & F.col("last").isNotNull() & (mine <= F.col("last"))
    more = F.coalesce((F.col("cell") < F.col("_c")) | in_last, F.lit(False)) & (F.col("part") > 0)
    return F.col("whole").cast("long") + F.when(more, 1).otherwise(0).cast("long")


def _sized(row: DataFrame, text: Column, doc_id: Column, source: Column, seed: int) -> DataFrame:
    t = F.coalesce(text, F.lit(""))
    return row.select(
        "*", doc_id.alias("doc_id"), source_key(source).alias("source"), n_words(text).alias("size"), F.xxhash64(t).alias("tie"), _uniform(doc_id, t, seed).alias("u")
    )


def plan_mix(df: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 9) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` of every row.

    A document is expected in the mix in proportion to the root of its size, three times at most, such that its source's words come to the
    target (``shares``).  The whole part of that number is certain.  The rest is the inclusion share of one more copy, by
    a Pareto order sample: rows rank by their random odds over their inclusion odds (Rosén, 1997) and the first ones are taken until
    their sizes add up to what the target still needs, so the sample is fixed to within half a document.
    Random numbers are digests of the id, so reruns agree.  Ties go by id, size, and a digest of the text; rows equal in
    all share one fate.  A null source is a source; the digest of a null id is that of the text; a null or empty text has size 0, takes no words.
    """
    own = df.select(df[f"`{text}`"].alias("text"), df[f"`{doc_id}`"].alias("id"), df[f"`{source}`"].alias("src"))
    sized = written(_sized(own, F.col("text"), F.col("id"), F.col("src"), seed).drop("text", "id", "src"), "sized")
    cuts = cutoffs(sized, shares(sized, targets(sized)))
    placed = _placed(sized, cuts).withColumn("copies", _copies(sized))
    return placed.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(df: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 9) -> DataFrame:
    """The rows of ``df``, each as many times as :func:`plan_mix` gives it copies; columns unchanged."""
    own = _sized(packed(df), F.col(f"row.`{text}`"), F.col(f"row.`{doc_id}`"), F.col(f"row.`{source}`"), seed)
    sized = written(own.drop("row"), "sized")
    cuts = cutoffs(sized, shares(sized, targets(sized)))
    placed = _placed(own, cuts).withColumn("copies", _copies(own)).where("copies > 0")
    return placed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op9_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words that the mix takes of it."""
    return plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('9:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
f AS (SELECT source, source_size, weight::DOUBLE AS weight, 3.0::DOUBLE * source_size AS stop,
        coalesce(sum(3.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(weight::DOUBLE) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight,
        row_number() OVER o AS r
      FROM s WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source)),
v AS (SELECT arg_min(((SELECT sum(size) FROM d)::DOUBLE - filled) / left_weight, r) AS x
      FROM f WHERE stop >= ((SELECT sum(size) FROM d)::DOUBLE - filled) / left_weight * weight),
t AS (SELECT source, source_size, least(stop, x * weight) AS target FROM f, v),
g AS (SELECT source, greatest(ceil(sqrt(size::DOUBLE)), 1)::BIGINT AS m, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
h AS (SELECT g.*, t.target, t.source_size,
        (t.target - 3.0::DOUBLE * coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / nullif(sum(words::HUGEINT * m) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS x
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source WINDOW w AS (PARTITION BY g.source ORDER BY m DESC)),
l AS (SELECT source, max_by(x, m) FILTER (x * m <= 3.0::DOUBLE) AS x FROM h GROUP BY source),
e AS (SELECT g.source, g.m, t.source_size, t.target, g.words,
        CASE WHEN t.source_size > 0 THEN coalesce(CASE WHEN l.x IS NULL THEN NULL ELSE least(3.0::DOUBLE, l.x * m) END, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS expected
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source JOIN l ON g.source IS NOT DISTINCT FROM l.source),
n AS (SELECT source, any_value(target) - sum(words * floor(expected + 1e-12)::BIGINT)::DOUBLE AS need FROM e GROUP BY source),
p AS (SELECT d.*, e.source_size, e.target, n.need, floor(expected + 1e-12) AS whole, greatest(expected - floor(expected + 1e-12), 0) AS part
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source AND greatest(ceil(sqrt(d.size::DOUBLE)), 1)::BIGINT = e.m
      JOIN n ON d.source IS NOT DISTINCT FROM n.source),
q AS (SELECT *, u / (1 - u) / (part / (1 - part)) AS q FROM p WHERE part > 0),
c AS (SELECT doc_id, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM q)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN part > 0 AND upto - size / 2 <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM p LEFT JOIN c USING (doc_id)
"""
