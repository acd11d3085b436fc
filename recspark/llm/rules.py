"""Quality rules with verdicts on whole hosts (operator 10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import written
from .common import BLANK, kept as kept_columns, packed, sent, unpacked, words_of

#: A document fails below this many words, or if more than this share of its words is in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: A host goes if more than this share of its documents is expected to fail.
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"


def text_stats(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the rule columns of a text.

    ``n_words``; ``word_chars``, code points in words; ``n_symbols``; ``n_dup_lines``, lines with a word that equal
    an earlier line; ``n_repeat_words``, words inside windows of five words that occur at least twice in the text;
    ``base_failed``.  A null text counts as empty: no words, so it fails.

    Windows are compared by 64-bit hashes within one text.  Only a text that has an equal pair sorts its windows.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform(
        F.when(F.size("_w") >= WINDOW, F.sequence(F.lit(0), F.size("_w") - WINDOW)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)]),
    )
    placed = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    near = lambda i: F.get("_s", i)["h"]
    starts = F.array_sort(
        F.transform(F.filter("_s", lambda x, i: F.coalesce((near(i - 1) == x["h"]) | (near(i + 1) == x["h"]), (near(i - 1) == x["h"]), (near(i + 1) == x["h"]))), lambda x: x["i"])
    )
    covered = F.aggregate(
        F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    out = (
        df.withColumn("_w", words_of(text))
        .withColumn("_h", hashes)
        .withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), placed))
        .withColumn("_p", F.when(F.col("_s").isNotNull(), starts))
        .withColumn("_l", lines)
        .withColumns(
            {
                "n_words": F.size("_w").cast("long"),
                "word_chars": F.length(F.regexp_replace(t, BLANK, "")).cast("long"),
                "n_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"),
                "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
                "n_repeat_words": F.coalesce(F.when(F.col("_p").isNotNull(), covered), F.lit(0).cast("long")),
            }
        )
        .drop("_w", "_h", "_s", "_p", "_l")
    )
    too_repeated = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    failed = (F.col("n_words") < MIN_WORDS) | too_repeated
    # as a generated row, so that a filter on the outcome cannot pull copies of the expressions down to the scan
    once = F.explode(F.array(F.struct(*RULES[:-1], failed.alias("base_failed"))))
    return out.withColumn("_rules", once).drop(*RULES[:-1]).select("*", "_rules.*").drop("_rules")


def host_rates(scored: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per ``host`` of ``scored`` (``host``, ``base_failed``): ``n``, ``failed``, ``rate``, ``rejected``.

    The share of failures is shrunk: a beta prior is fitted to the shares of all hosts by the method of moments
    (their weighted variance less what sampling alone makes), and ``rate`` is the posterior mean.  Small hosts
    therefore need more than one bad document.  With one host, or without any spread, the prior counts as much as
    ten documents.  A null host is a host.  Counts are combined before the shuffle, so a hot host costs a row per task.
    """
    n, f = F.col("n"), F.col("failed")
    hosts = written(
        scored.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts"
    )
    m = hosts.agg(F.count(F.lit(1)), F.sum("n"), F.sum("failed"), F.sum((f * f) / n)).first()
    k, total, bad = m[0], float(m[1] or 0), float(m[2] or 0)
    mean = bad / total if total else 0.0
    noise = mean * (1 - mean)
    spread = (float(m[3] or 0) - total * mean * mean) / total if total else 0.0
    between = spread - noise * k / total if total else 0.0
    strength = min(max(noise / between - 1, 1.0), 1e6) if between > 0 and noise > 0 else 10.0
    rate = (f + F.lit(strength * mean)) / (n + F.lit(strength))
    return hosts.select("host", "n", "failed", rate.alias("rate")).withColumn("rejected", F.col("rate") > max_rate)


def _rejected(scored: DataFrame, max_rate: float) -> DataFrame:
    hosts = host_rates(scored.select("host", "base_failed"), max_rate)
    return sent(hosts.where("rejected").select(F.col("host").alias("bad_host"), F.lit(True).alias("bad")), 64)


def judge(df: DataFrame, text: str = "text", host: str = "source", keep: tuple[str, ...] | None = None, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default), its rule columns, and ``kept``.

    ``kept`` is false if the document itself fails, else what its host gets.  An empty table gives an empty one;
    repeated rows are judged alike.  Columns of ``df`` with the names of the new ones are replaced.
    """
    own = df.select(kept_columns(df, keep, replaced=(*RULES, "kept")), df[f"`{text}`"].alias("text"), df[f"`{host}`"].alias("host"))
    scored = written(text_stats(own, F.col("text")).drop("text"), "rules")
    out = scored.join(_rejected(scored, max_rate), F.col("host").eqNullSafe(F.col("bad_host")), "left")
    kept = ~F.col("base_failed") & F.col("bad").isNull()
    return out.select("row.*", *RULES, kept.alias("kept"))


RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def keep_good(df: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``df`` that the rules and their host's verdict keep, all columns unchanged.

    The rules run once for the hosts and once for the rows: that costs less than to keep a copy of all texts with the outcome.
    """
    own = packed(df).select("row", F.col(f"row.`{text}`").alias("text"), F.col(f"row.`{host}`").alias("host"))
    scored = text_stats(own, F.col("text")).select("row", "host", "base_failed")
    bad = _rejected(scored, max_rate)
    good = scored.where(~F.col("base_failed"))
    return unpacked(good.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left_anti"))


def op10_host_rules(spark, sf_dir: str) -> DataFrame:
    """The rule columns and the verdict of every document; its ``source`` is its host."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=("doc_id",))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
c AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r),
s AS (SELECT d.doc_id, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(d.t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(d.t, '[^{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l.l) - len(list_distinct(l.l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n_repeat, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (r) JOIN l USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
m AS (SELECT count(*) AS k, sum(n) AS total, sum(f) / sum(n) AS mean, sum(f * f / n) AS sq FROM h),
v AS (SELECT mean, mean * (1 - mean) AS noise, (sq - total * mean * mean) / total - mean * (1 - mean) * k / total AS between_hosts FROM m),
a AS (SELECT mean, CASE WHEN between_hosts > 0 AND noise > 0 THEN least(greatest(noise / between_hosts - 1, 1), 1e6) ELSE 10 END AS strength FROM v),
x AS (SELECT source, (f + strength * mean) / (n + strength) > {MAX_HOST_RATE} AS rejected FROM h, a)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM b JOIN x ON b.source IS NOT DISTINCT FROM x.source
"""
