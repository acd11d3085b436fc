"""Quality by the perplexity of an interpolated modified Kneser-Ney model of character n-grams (operator 1)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import written
from .common import sent

#: Characters per n-gram, and the marks around a text.
ORDER, BEGIN, FINISH = 4, "\x02", "\x03"
#: A document is kept up to this quantile of the perplexities of trusted text in its language: one trusted document in twenty may go.
QUANTILE = 0.95
#: The quantile over all languages weighs as much as this many documents of a language in its threshold.
PRIOR = 10
#: Documents are dealt to so many folds; those of a fold are scored by a model of the trusted text of the others.
FOLDS = 2
#: Log perplexities are counted in steps of this for the quantiles.
STEP = 0.001
#: Text (bytes) that one block scores together, and characters that are hashed at once.
BLOCK_BYTES, BLOCK = 16 << 20, 1 << 20


# ---- n-grams -----------------------------------------------------------------------------


def plain(text: str | None) -> str:
    """White space as single blanks."""
    return " ".join((text or "").split())


def _marked(text: str, order: int) -> np.ndarray:
    return np.frombuffer((BEGIN * (order - 1) + text + FINISH).encode("utf-32-le", "surrogatepass"), np.uint32)


def _digests(codes: np.ndarray, order: int) -> np.ndarray:
    n = len(codes) - order + 1
    h = np.zeros(n, np.uint64)
    for i in range(order):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : n + i]
    return h


def _pieces(texts: Iterable[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Digests of the n-grams of texts and the text that each is of, about ``BLOCK`` at a time; a long text comes in parts."""
    held, owners, total = [], [], 0
    for i, t in enumerate(texts):
        codes = _marked(t, order)
        for at in range(0, len(codes) - order + 1, BLOCK):
            part = codes[at : at + BLOCK + order - 1]
            held.append((part, _digests(part, order)))
            owners.append(np.full(len(held[-1][1]), i))
            total += len(owners[-1])
            if total >= BLOCK:
                yield held, np.concatenate(owners)
                held, owners, total = [], [], 0
    if held:
        yield held, np.concatenate(owners)


def _merged(windows: list[np.ndarray], digests: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams in the order in which they first come, their digests and counts."""
    codes, unique = pd.factorize(np.concatenate(digests))
    first = np.empty(len(unique), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return np.concatenate(windows)[first], unique, np.bincount(codes, np.concatenate(counts)).astype(np.int64)


def _counted(texts: Iterable[str], order: int) -> tuple[list[str], np.ndarray]:
    """The distinct n-grams of texts and how often each occurs.  Texts are taken one after the other, and what is held grows with the distinct n-grams alone."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held, most = 0, BLOCK // 4
    for parts, _ in _pieces(texts, order):
        digests = np.concatenate([h for _, h in parts])
        codes, unique = pd.factorize(digests)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(c, order) for c, _ in parts])
        found.append((windows[first], unique, np.bincount(codes, minlength=len(unique))))
        held += len(unique)
        if held >= most:
            found = [_merged(*map(list, zip(*found)))]
            held = len(found[0][1])
            most = max(BLOCK // 4, 2 * held)
    if not found:
        return [], np.array([], np.int64)
    windows, _, totals = _merged(*map(list, zip(*found)))
    letters = windows.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [letters[i : i + order] for i in range(0, len(letters), order)], totals


# ---- model -------------------------------------------------------------------------------


def _discounts(table: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney smoothing (Chen and Goodman, 1998) from the counts of counts.

    Where the estimate is undefined for lack of data the discount is half the count it is for.
    """
    n = dict(table.where("c <= 4").groupBy("c").count().collect())
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.0, 2 - 3 * y * n3 / n2 if n2 and n3 else 0.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 0.0]
    return [d if 0 < d < i else i / 2 for i, d in enumerate(raw, 1)]


def train(texts: DataFrame, order: int = ORDER) -> dict:
    """The count tables of a model of the column ``text``: for each length from 1 to ``order`` the n-grams and their contexts.

    The longest n-grams have their number of occurrences; shorter ones the number of different characters before them.
    Tables are sharded by n-gram and context; the driver holds three discounts a length and the totals of length 1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, n = _counted((plain(t.as_py()) for t in batch.column(0)), order)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["gram", "n"])

    rows = texts.select("text").mapInArrow(count, "gram string, n long")
    tables = {order: written(rows.groupBy("gram").agg(F.sum("n").alias("c")), "grams")}
    for k in range(order - 1, 0, -1):
        tables[k] = written(tables[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("c")), "grams")
    model: dict = {"order": order, "tables": tables, "contexts": {}, "discounts": {}}
    for k, table in tables.items():
        d = model["discounts"][k] = _discounts(table)
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        total = table.groupBy(F.substring("gram", 1, k - 1).alias("context")).agg(F.sum("c").alias("total"), (F.sum(taken) / F.sum("c")).alias("backoff"))
        if k == 1:
            row = total.first()
            model["letters"] = (row["total"], row["backoff"], table.count()) if row else (0, 1.0, 0)
        else:
            model["contexts"][k] = written(total, "contexts")
    return model


def log_probabilities(grams: DataFrame, model: dict) -> DataFrame:
    """``gram``, ``logp`` (natural) for distinct n-grams of the model's order: the last character given the others.

    From the shortest up, each length joins its counts, its contexts and the probability of its end.  An n-gram that was never
    seen gets what its context leaves over; a context that was never seen leaves everything to the shorter one; a character
    that was never seen gets one share among all known ones and itself.
    """
    order = model["order"]
    needed = {order: grams.select("gram")}
    for k in range(order - 1, 0, -1):
        needed[k] = needed[k + 1].select(F.substring("gram", 2, k).alias("gram")).distinct()
    total, backoff, known = model["letters"]
    scored = None
    for k in range(1, order + 1):
        d = model["discounts"][k]
        own = F.greatest(F.col("c") - F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2]), F.lit(0.0))
        out = needed[k].join(model["tables"][k], "gram", "left")
        if k == 1:
            p = F.coalesce(own, F.lit(0.0)) / F.lit(float(max(total, 1))) + F.lit(backoff / (known + 1))
        else:
            out = out.withColumn("context", F.substring("gram", 1, k - 1)).join(model["contexts"][k], "context", "left")
            out = out.withColumn("end", F.substring("gram", 2, k - 1)).join(scored.withColumnRenamed("gram", "end"), "end")
            p = F.when(F.col("total").isNull(), F.col("p")).otherwise(F.coalesce(own, F.lit(0.0)) / F.col("total") + F.col("backoff") * F.col("p"))
        scored = out.select("gram", p.alias("p"))
    return scored.select("gram", F.log("p").alias("logp"))


# ---- scores ------------------------------------------------------------------------------


def log_perplexities(docs: DataFrame, model: dict) -> DataFrame:
    """``id``, ``n`` (characters and the end mark) and ``log_ppl``, the mean negative log probability of a document's characters.

    Documents are dealt to blocks; a block asks for each of its distinct n-grams once, the questions are answered by joins on
    the sharded counts, and the answers go back to the block.  So what is shuffled is the text, once, and far fewer n-grams.
    A text without any word has a null ``log_ppl``.
    """
    order = model["order"]
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(n // (4 * FOLDS), -(-size // BLOCK_BYTES), 1)  # of one fold
    dealt = docs.select("id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).alias("block")).repartition(n, "block")

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        grams, _ = _counted(map(plain, pdf["text"]), order)
        return pd.DataFrame({"block": np.full(len(grams), pdf["block"].iloc[0]), "gram": grams})

    def answer(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        letters = np.frombuffer("".join(answers["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order)
        digests = np.zeros(len(letters), np.uint64)
        for i in range(order):
            digests = digests * np.uint64(0x9E3779B97F4A7C15) + letters[:, i]
        by = np.argsort(digests)
        digests, logp = digests[by], answers["logp"].to_numpy()[by]
        sums, counts = np.zeros(len(pdf)), np.zeros(len(pdf), np.int64)
        for held, owners in _pieces(map(plain, pdf["text"]), order):
            codes, unique = pd.factorize(np.concatenate([h for _, h in held]))
            sums += np.bincount(owners, logp[np.searchsorted(digests, unique)][codes], minlength=len(pdf))
            counts += np.bincount(owners, minlength=len(pdf))  # a text has as many n-grams as characters and its end
        return pd.DataFrame({"id": pdf["id"], "n": counts, "log_ppl": np.where(counts > 1, -sums / counts, np.nan)})

    asked = written(dealt.groupBy("block").applyInPandas(ask, "block long, gram string"), "asked")  # each length reads it
    scored = log_probabilities(asked.select("gram").distinct(), model)
    answered = asked.join(scored, "gram").select("block", "gram", "logp")
    kind = docs.schema["id"].dataType.simpleString()
    out = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(answer, f"id {kind}, n long, log_ppl double")
    return out.withColumn("log_ppl", F.when(~F.isnan("log_ppl"), F.col("log_ppl")))


def thresholds(scored: DataFrame, quantile: float = QUANTILE, least: int = 1) -> DataFrame:
    """``lang``, ``limit``, ``n``: the quantile of ``log_ppl`` of the ``n`` rows per language, to within one step, and over all as lang null, all true.

    Counts per step are exact whatever the order of rows, and a language has some thousands of steps at most.
    """
    step = F.ceil(F.col("log_ppl") / STEP).cast("int")
    counts = written(scored.where("log_ppl is not null").groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")), "steps")
    every = counts.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(None).cast(scored.schema["lang"].dataType).alias("lang"), F.lit(True).alias("every"), "step", "n")
    both = counts.select("lang", F.lit(False).alias("every"), "step", "n").union(every)
    order = Window.partitionBy("lang", "every").orderBy("step")
    upto = both.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("lang", "every")))
    found = upto.where(F.col("upto") >= F.ceil(F.col("all") * quantile)).groupBy("lang", "every").agg((F.min("step") * STEP).alias("limit"), F.first("all").alias("n"))
    return found.where(F.col("every") | (F.col("n") >= least)).select("lang", "every", "limit", "n")


def shrunk(own: Column, n: Column, overall: float | None, prior: float = PRIOR) -> Column:
    """The threshold of a language with ``n`` trusted documents: its own quantile, drawn to the overall one the more the fewer they are.

    It has no jump: without any trusted text (null ``own``) it is the overall one, and each document moves it a little.
    """
    common = F.lit(overall).cast("double")
    return F.coalesce((n * own + prior * common) / (n + prior), common)


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``threshold``, ``kept`` of every row of ``docs``.

    Trusted text is that of documents whose every label in ``labels`` (``doc_id``, ``quality``) is 1.  Documents are dealt to
    folds by their ids, and those of a fold, trusted or not, are scored by a model of the trusted text of the other folds.  So
    no document is scored by a model that has seen it, and all trusted ones give the threshold of their language, a quantile of
    their perplexities that is drawn to the quantile over all languages where they are few; a null language is one.
    Without any trusted text nothing has a threshold, and every text with a word is kept.  A null or empty text has no
    perplexity and is not kept.  Repeated rows get the same result.
    """
    own = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"), docs[f"`{lang}`"].alias("lang"))
    own = own.withColumn("fold", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0)))
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1 and doc_id is not null").select("doc_id")
    good = written(good, "trusted")
    trusted = own.join(sent(good, 16), "doc_id", "left_semi")
    scored = None
    for fold in range(FOLDS):
        model = train(trusted.where(F.col("fold") != fold), order)
        packed = own.where(F.col("fold") == fold).select(F.struct("doc_id", "lang").alias("id"), "text")
        part = written(log_perplexities(packed, model).select("id.doc_id", "id.lang", "log_ppl"), "scores")
        scored = part if scored is None else scored.union(part)
    limits = written(thresholds(scored.join(sent(good, 16), "doc_id", "left_semi"), quantile), "limits")
    every = limits.where("every").first()
    ours = limits.where("not every").select(F.col("lang").alias("_lang"), "limit", "n")
    out = scored.join(sent(ours, 64), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = shrunk(F.col("limit"), F.col("n"), every["limit"] if every else None)
    kept = F.col("log_ppl").isNotNull() & F.coalesce(F.col("log_ppl") <= limit, F.lit(True))
    return out.select("doc_id", "lang", F.exp("log_ppl").alias("perplexity"), F.exp(limit).alias("threshold"), kept.alias("kept"))


def op1_perplexity(spark, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the documents labelled good, and whether it is kept."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return judge(read("documents"), read("labels"))
