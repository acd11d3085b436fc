"""Runs of repeated words, by seeds on diagonals (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import kept, words_of

#: The least length of a run, in words, and how often its period must at least fit in it.
LEAST, POWER = 24, 3
#: Characters of the texts that are looked through at once.
GROUP_CHARS = 8_000_000

RUNS = "array<struct<start:long,length:long,period:long>>"


def least_overlap(least: int = LEAST, power: int = POWER) -> int:
    """How many words of a run, at least, equal the word one period on: the longest seed that no run can lack.

    A run of period q is as long as ``max(least, power * q)``, so max(least - q, (power - 1) * q) words have a partner.
    """
    return min(max(least - q, (power - 1) * q) for q in range(1, least + 1))


def _seeds(h: np.ndarray, doc: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and lags of ``k``-grams whose next occurrence in the document is more than ``low`` and at most ``high`` words on.

    Also returned: the documents in which any ``k``-gram occurs twice.  ``h`` has a hash of the ``k``-gram at each place.
    """
    whole = np.flatnonzero(doc[: len(h)] == doc[k - 1 : k - 1 + len(h)])
    by = whole[np.argsort(h[whole], kind="stable")]
    a, b = by[:-1], by[1:]
    again = (h[a] == h[b]) & (doc[a] == doc[b])
    a, b = a[again], b[again]
    lag = b - a
    fits = (lag > low) & (lag <= high)
    return a[fits], lag[fits], np.unique(doc[a])


def _extended(word: np.ndarray, at: int, lag: int, lo: int, hi: int) -> tuple[int, int]:
    """The stretch of equal words around places ``at`` and ``at + lag``, as far as ``lo`` and ``hi`` allow: first and end of the run."""
    step, end = 64, at + lag
    while end < hi:  # to the right, in steps that double
        n = min(step, hi - end)
        same = word[end : end + n] == word[end - lag : end - lag + n]
        if not same.all():
            end += int(same.argmin())
            break
        end, step = end + n, step * 2
    step, start = 64, at
    while start > lo:
        n = min(step, start - lo)
        same = (word[start - n : start] == word[start - n + lag : start + lag])[::-1]
        if not same.all():
            start -= int(same.argmin())
            break
        start, step = start - n, step * 2
    return start, end


def runs_of(word: np.ndarray, ends: np.ndarray, least: int = LEAST, power: int = POWER) -> list[list[tuple[int, int, int]]]:
    """For each document, the runs (start, length, period) by start and period.

    ``word`` holds the numbers of the words of all documents and ``ends`` where each document ends.  Seeds are pairs of
    occurrences of a k-gram in one document.  k is the least overlap, then doubles; a size serves the lags of up to k words that no
    smaller one has, whose overlap is at least k.  As k is not below the lag, two occurrences of a run's k-gram that lie one
    period apart have none between them (a third would give the run a smaller period, by Fine and Wilf), so the next
    occurrence of a k-gram is all that has to be looked at, and pairs are never more than words.  A seed is extended both
    ways unless an earlier one on its diagonal, that is of its lag, has already covered it.
    """
    starts = np.append(0, ends)[:-1].astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    k, low = least_overlap(least, power), 0
    place = np.arange(len(word))  # of the words still looked at, in ``word``
    while len(place) >= k:
        w, own = word[place], doc[place]
        a, lag, again = _seeds(_hashes(w, k), own, k, low, k)
        a = place[a]
        by = np.lexsort((a, lag, doc[a]))
        a, lag = a[by], lag[by]
        # a seed right after another of its diagonal is covered by what that is extended to
        head = np.append(True, (lag[1:] != lag[:-1]) | (a[1:] != a[:-1] + 1)) if len(a) else np.array([], bool)
        covered: dict[tuple[int, int], int] = {}
        for i, q in zip(a[head].tolist(), lag[head].tolist()):
            d = int(doc[i])
            if i < covered.get((d, q), -1):
                continue
            start, end = _extended(word, i, q, int(starts[d]), int(ends[d]))
            covered[d, q] = end - q
            if end - start >= max(least, power * q):
                found[d].append((start - int(starts[d]), end - start, q))
        sizes = np.diff(np.append(0, ends))
        more = again[sizes[again] >= power * (k + 1)]  # longer periods need longer texts
        place = place[np.isin(own, more)]
        k, low = 2 * k, k
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def _hashes(w: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` numbers in a row, put together from those of shorter stretches."""
    h = _mixed(w.astype(np.uint64) + np.uint64(1))
    out, done, width, size = None, 0, 1, k
    while True:
        if size & 1:
            out = h if out is None else _mixed(out[: len(out) - width] * np.uint64(0x9E3779B97F4A7C15) + h[done:])
            done += width
        size >>= 1
        if not size:
            return out
        h = _mixed(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])
        width *= 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _without_repeats(words: pa.Array, ends: np.ndarray, runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    """The texts of the words that are in no run after its first period, joined by blanks."""
    lost = np.zeros(len(words) + 1, np.int64)
    starts = np.append(0, ends)[:-1]
    for at, found in zip(starts, runs):
        for start, length, period in found:
            lost[at + start + period] += 1
            lost[at + start + length] -= 1
    stays = np.cumsum(lost[:-1]) == 0
    if not stays.all():
        words, ends = words.filter(pa.array(stays)), np.append(0, np.cumsum(stays))[ends]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), words), " ")


def _looked_through(least: int, power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + GROUP_CHARS, "right")))
                yield part(batch.slice(at, to - at))
                at = to

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = pc.split_pattern_regex(batch.column(1), r"[\x20\x09-\x0D]+")
        words = lists.flatten()
        held = pc.not_equal(words, "")
        ends = np.append(0, np.cumsum(held.to_numpy(zero_copy_only=False)))[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
        words = words.filter(held)
        runs = runs_of(words.dictionary_encode().indices.to_numpy(zero_copy_only=False), ends, least, power)
        flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], ["start", "length", "period"])
        offsets = pa.array(np.cumsum([0, *map(len, runs)]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(offsets, rows), _without_repeats(words, ends, runs)], names=["row", "runs", "collapsed"]
        )

    return run


def find_runs(df: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None, least: int = LEAST, power: int = POWER) -> DataFrame:
    """The rows of ``df`` (columns ``keep``, all by default) with ``runs`` and ``collapsed``.

    A run is a stretch of words in which words q apart are equal, q being the smallest such period, that is at least ``least``
    words and ``power`` periods long and that no neighbouring word extends; ``runs`` lists ``start`` (number of the word, from 0), ``length``
    and ``period`` of all of them, by start and period.  ``collapsed`` is the text of the words that no run holds after its first period,
    joined by one blank.  Words are parted by blanks and the control characters from tab to carriage return.  A null or empty
    text has no runs and collapses to the empty text; very long ones are looked through whole.  Repeated rows stay, each with its result, and columns that are already
    called ``runs`` or ``collapsed`` are replaced.  Nothing is shuffled.
    """
    if power < 3 or least < 2:
        raise ValueError("seeds of the least overlap find all runs of three periods and more only")
    keep = tuple(c for c in (df.columns if keep is None else keep) if c.lower() not in ("runs", "collapsed"))
    rows = df.select(kept(df, keep), F.coalesce(df[f"`{text}`"], F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])
    return rows.mapInArrow(_looked_through(least, power), schema).select("row.*", "runs", "collapsed")


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text, with the end of every tenth document (by a digest of its id) replaced by repeats of a few of its words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        bound = F.array(F.struct(a.cast("int").alias("a"), p.cast("int").alias("p")))
        return F.flatten(
            F.transform(bound, lambda b: F.concat(F.slice(w, 1, b["a"]), F.transform(F.sequence(b["a"], F.size(w) - 1), lambda i: F.get(w, b["a"] + (i - b["a"]) % b["p"]))))
        )

    made = F.transform(F.array(words_of(text)), lambda w: F.when(F.size(w) > 0, F.array_join(tail(w), " ")).otherwise(F.lit("")))
    return F.when(h % 10 == 0, F.get(made, 0)).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of every document (of every tenth after its end was made to repeat), the steepest one and what is left without repeats."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_runs(docs.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text")), keep=("doc_id",))
    # the greatest exact quotient; runs come by start and period, so the first of equal ones stays
    best = F.aggregate("runs", F.get("runs", 0), lambda m, r: F.when(_product(r["length"], m["period"]) > _product(m["length"], r["period"]), r).otherwise(m))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    out = found.withColumn("best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _product(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")
