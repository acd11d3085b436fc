"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks (operator 7)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..workspace import written
from .common import kept
from .simhash import fingerprints

#: The kernel: subsequences of three letters that span at most this many, each weighed by DECAY to the power of its span.
SPAN, DECAY = 6, 0.5
#: Letters of a unit that are compared at once; a longer unit is cut into pieces that overlap by OVERLAP.
LETTERS, OVERLAP = 32, 12
#: The most labelled documents that a model is fitted on: toxic, and clean.  They are those with the least digests of their ids.
TOXIC_DOCS, CLEAN_DOCS = 4_000, 24_000
#: Words learned from: the most toxic ones that are looked at, clean ones by frequency, and clean ones by digest; landmarks of each of the three.
TOXIC_WORDS, COMMON_WORDS, OTHER_WORDS = 400, 2_000, 3_000
TOXIC_MARKS, CLEAN_MARKS = 200, 150
#: A toxic word must explain this many toxic documents in which no better word is, or be in this share of as many as the median of such words.
LEAST_EXPLAINED, AS_FREQUENT = 2, 0.6
#: Rounds in which the clean words that score highest join the clean examples, and how many join.
HARD_ROUNDS, HARD_WORDS = 2, 500
#: Cost of an error in the machine, and the score at which units are cut off below.
COST, FLOOR = 10.0, -1.5
#: Words whose scores a worker remembers.
REMEMBERED = 500_000
#: Held-out documents: crc32 of the id as text has this remainder by 5.
FOLDS, HELD_OUT = 5, 0


# ---- units -------------------------------------------------------------------------------

_SPELLED = re.compile(r"(?<!\S)\w(?:\s+\w(?!\S)){2,}")
_SPLIT = re.compile(r"[\W_]+")


def tokens(text: str | None) -> set[str]:
    """The distinct tokens of a text in lower case: what white space parts, and runs of single letters as one."""
    low = (text or "").lower()
    return {*low.split(), *("".join(m.group().split()) for m in _SPELLED.finditer(low))}


def units(token: str) -> list[str]:
    """What a token is judged by: its letters and digits with everything between them left out, and the parts between."""
    if token.isalnum():
        return [token]
    parts = [p for p in _SPLIT.split(token) if p]
    return parts if len(parts) < 2 else ["".join(parts), *parts]


# ---- kernel ------------------------------------------------------------------------------

_OFFSETS = [(j, k) for j, k in combinations(range(1, SPAN), 2)]


def _letters(words: list[str]) -> np.ndarray:
    """Rows of letter numbers below 64, 0 for none: a mark, the word, a mark."""
    codes = np.frombuffer("".join(w[:LETTERS].ljust(LETTERS, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, LETTERS)
    small = np.where((codes >= 97) & (codes <= 122), codes - 96, 37 + (codes * np.uint32(2654435761) >> np.uint32(16)) % 25)
    small = np.where((codes >= 48) & (codes <= 57), codes - 21, small)
    small = np.where(codes == 0, 0, small).astype(np.int32)
    out = np.zeros((len(words), LETTERS + 2), np.int32)
    out[:, 0] = 62
    out[:, 1:-1] = small
    out[np.arange(len(words)), np.minimum([len(w) for w in words], LETTERS) + 1] = 63
    return out


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The occurrences of three letters in order within SPAN of each word: word, number of the three, weight."""
    rows, codes, weights = [], [], []
    x = _letters(words)
    for j, k in _OFFSETS:
        a, b, c = x[:, : x.shape[1] - k], x[:, j : x.shape[1] - k + j], x[:, k:]
        r, at = np.nonzero((a > 0) & (c > 0))
        rows.append(r)
        codes.append(a[r, at] << 12 | b[r, at] << 6 | c[r, at])
        weights.append(np.full(len(r), DECAY ** (k + 1)))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(weights)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The feature vectors of words, of length 1: word, number of the three letters, value.  Their products are the kernel."""
    rows, codes, weights = subsequences(words)
    key, place = np.unique(rows.astype(np.int64) << 18 | codes, return_inverse=True)
    value = np.bincount(place, weights)
    row = key >> 18
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(words)))
    return row, key & ((1 << 18) - 1), value / norm[row]


def kernel(words: list[str], marks: list[str]) -> np.ndarray:
    """The normalised kernel of each word with each mark."""
    row, code, value = features(marks)
    known, place = np.unique(code, return_inverse=True)
    dense = np.zeros((len(known) + 1, len(marks)), np.float32)
    dense[place, row] = value
    where = np.full(1 << 18, len(known))
    where[known] = np.arange(len(known))
    out = np.zeros((len(words), len(marks)), np.float32)
    for at in range(0, len(words), 500):
        r, c, v = features(words[at : at + 500])  # in order of words
        held = where[c] < len(known)
        r, c, v = r[held], c[held], v[held].astype(np.float32)
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.array([], np.int64)
        if len(first):
            out[at + r[first]] = np.add.reduceat(dense[where[c]] * v[:, None], first, axis=0)
    return out.astype(float)


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = COST) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by Newton steps; the last is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        margin = 1 - y * (x @ w)
        on = margin > 0
        xa, ca = x[on], cost * weight[on]
        reg = np.eye(len(w))
        reg[-1, -1] = 1e-6
        grad = reg @ w - xa.T @ (ca * y[on] * margin[on])
        step = np.linalg.solve(reg + (xa.T * ca) @ xa, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    """A word's score is the product of its feature vector with ``table`` plus ``bias``; a text's logit is ``slope`` times its best word's, plus ``offset``."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The machine's score of each word, not below FLOOR.

        The sum of the squares of all occurrences is at most the square of the vector's length, so it bounds the score from
        above; only words that the bound leaves over need the length itself.
        """
        out = np.full(len(words), FLOOR)
        if not words:
            return out
        rows, codes, weights = subsequences(words)
        dot = np.bincount(rows, weights * self.table[codes], minlength=len(words))
        least = np.sqrt(np.bincount(rows, weights * weights, minlength=len(words)))
        bound = np.where(dot > 0, dot / np.maximum(least, 1e-12), 0.0) + self.bias
        open_ = np.flatnonzero(bound > FLOOR)
        if len(open_):
            r, c, v = features([words[i] for i in open_])
            out[open_] = np.maximum(np.bincount(r, v * self.table[c], minlength=len(open_)) + self.bias, FLOOR)
        return out

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -60, 60)))


class Scorer:
    """Scores texts in one worker and remembers the scores of tokens."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def best(self, texts: list[str | None]) -> list[float]:
        """The score of the highest scoring word of each text; FLOOR for a text without words."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        held = [tokens(t) for t in texts]
        new = [t for t in set().union(*held) if t not in self.known]
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            words: dict[str, int] = {}
            of = []
            for t in some:
                pieces = [p for u in units(t) for p in _pieces(u)]
                of.append([words.setdefault(p, len(words)) for p in pieces])
            scores = self.model.word_scores(list(words)).tolist()
            for t, places in zip(some, of):
                self.known[t] = max((scores[i] for i in places), default=FLOOR)
        known = self.known
        return [max(map(known.__getitem__, h), default=FLOOR) for h in held]


def _pieces(unit: str) -> list[str]:
    if len(unit) <= LETTERS:
        return [unit]
    return [unit[i : i + LETTERS] for i in range(0, len(unit) - OVERLAP, LETTERS - OVERLAP)]


def _batched(texts: pa.Array, scorer: Scorer) -> list[float]:
    out, some, size = [], [], 0
    for t in texts:
        some.append(t.as_py())
        size += len(some[-1] or "")
        if size > 2_000_000:
            out += scorer.best(some)
            some, size = [], 0
    return out + scorer.best(some)


# ---- training ----------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``toxic`` of a bounded set of labelled documents outside the held-out fold, near copies left out."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold != HELD_OUT)
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = known.where("toxic = 1").orderBy(*order).limit(TOXIC_DOCS).union(known.where("toxic = 0").orderBy(*order).limit(CLEAN_DOCS))
    some = written(some, "labels")
    rows = written(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"]), "training")
    prints = fingerprints(rows.select("text", "doc_id", "toxic")).orderBy("doc_id").toPandas()
    fp, y = prints["fp"].to_numpy().view(np.uint64), prints["toxic"].to_numpy()
    keep = np.ones(len(fp), bool)
    for at in range(0, len(fp), 512):
        near = np.bitwise_count(fp[at : at + 512, None] ^ fp[None, : at + 512]) <= 4
        near &= y[at : at + 512, None] == y[None, : at + 512]
        near &= np.arange(min(at + 512, len(fp)))[None, :] < np.arange(at, at + len(near))[:, None]
        keep[at : at + 512] = ~near.any(axis=1)
    ids = rows.sparkSession.createDataFrame(prints.loc[keep, ["doc_id"]], rows.select("doc_id").schema)
    return written(rows.join(F.broadcast(ids), "doc_id"), "training")


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[tuple[str, int], int] = {}
        for t, y in zip(batch.column(0), batch.column(1)):
            y = y.as_py()
            for p in {p for token in tokens(t.as_py()) for u in units(token) for p in _pieces(u)}:
                found[p, y] = found.get((p, y), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([u for u, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32()), pa.array(list(found.values()), pa.int64())], names=["unit", "toxic", "n"]
        )


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of the labelled documents of ``docs`` (``doc_id``, ``text``); None if no document of one of the classes is left.

    The labels are of whole documents, so the toxic examples have to be found: of the words that are in toxic documents far
    more often than chance allows, those that explain documents no better one explains, and those about as frequent.  (Words that
    only copies of some toxic document share explain none and are rarer.)  Words of clean documents are the other examples, and the machine is fitted in the Nyström features of the landmarks among them.  Then the clean words that score
    highest join in.  Last, the best word's score of each document is turned into a probability.
    What the driver holds is bounded by the constants above.
    """
    rows = training_rows(docs, labels)
    sizes = dict(rows.groupBy("toxic").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return None
    counts = rows.select("text", F.col("toxic").cast("int")).mapInArrow(_unit_rows, "unit string, toxic int, n long")
    per = counts.groupBy("unit").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    per = written(per, "units")
    t, c = F.col("t"), F.col("c")
    xlog = lambda k, rate: F.when(k > 0, k * F.log(k / rate)).otherwise(0.0)
    both = t + c
    gain = xlog(t, both * n1 / (n1 + n0)) + xlog(c, both * n0 / (n1 + n0))
    # as many as by chance one unit in eight tables like this would have
    bar = float(np.log(max(per.count(), 1)) + 2)
    toxic = per.where((t * n0 > 10 * c * n1) & (gain > bar)).withColumn("gain", gain).orderBy(F.desc("gain"), "unit").limit(TOXIC_WORDS)
    positives = _explaining(rows.where("toxic = 1").select("text"), [r["unit"] for r in toxic.select("unit").collect()])
    if not positives:
        return None
    clean = per.where((c > 0) & (t * n0 <= 3 * c * n1))
    common = [r["unit"] for r in clean.orderBy(F.desc("c"), "unit").limit(COMMON_WORDS).select("unit").collect()]
    other = [r["unit"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(OTHER_WORDS).select("unit").collect()]
    negatives = list(dict.fromkeys(common + other))
    marks = list(dict.fromkeys(positives[:TOXIC_MARKS] + common[:CLEAN_MARKS] + other[:CLEAN_MARKS]))
    model = _machine(positives, negatives, marks)
    sc = rows.sparkSession.sparkContext
    for _ in range(HARD_ROUNDS):
        held = sc.broadcast((model.table, model.bias))

        def score(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            current = Model(*held.value)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(current.word_scores(batch.column(0).to_pylist()))], names=["unit", "s"])

        hard = clean.select("unit").mapInArrow(score, "unit string, s double").where(F.col("s") > -0.9).orderBy(F.desc("s"), "unit").limit(HARD_WORDS)
        hard = [r["unit"] for r in hard.collect()]
        negatives = list(dict.fromkeys(negatives + hard))
        model = _machine(positives, negatives, list(dict.fromkeys(marks + hard[:CLEAN_MARKS])))
    scores = _scored(rows.select("text", "toxic"), model, "s").toPandas()
    slope, offset = _platt(scores["s"].to_numpy(), scores["toxic"].to_numpy())
    return Model(model.table, model.bias, slope, offset)


def _explaining(texts: DataFrame, words: list[str]) -> list[str]:
    """The words that explain the texts: each next one is in the most texts that none before it is in; then those as frequent."""
    number = {w: i for i, w in enumerate(words)}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted({number[p] for token in tokens(t.as_py()) for u in units(token) for p in _pieces(u) if p in number}) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32()))], names=["held"])

    held = [r["held"] for r in texts.mapInArrow(found, "held array<int>").collect()]
    has = np.zeros((len(held), len(words)), bool)
    for i, places in enumerate(held):
        has[i, places] = True
    out, left = [], np.ones(len(held), bool)
    while len(out) < len(words):
        gains = has[left].sum(axis=0)
        best = int(gains.argmax())
        if gains[best] < LEAST_EXPLAINED:
            break
        out.append(words[best])
        left &= ~has[:, best]
    if not out:
        return []
    counts = has.sum(axis=0)
    bar = AS_FREQUENT * np.median([counts[number[w]] for w in out])
    return out + [w for w in words if w not in set(out) and counts[number[w]] >= bar]


def _machine(positives: list[str], negatives: list[str], marks: list[str]) -> Model:
    """The machine in Nyström features, folded into one weight for each subsequence of the landmarks.

    The features of a word are its kernel with the landmarks times the inverse root of the landmarks' own kernel; a linear
    machine on them is a weighted sum of kernels, and that is one product with the weighted sum of the landmarks' vectors.
    """
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    words = positives + negatives
    y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
    weight = np.where(y > 0, len(negatives) / len(positives), 1.0) / 10
    w = fit_svm(kernel(words, marks) @ root, y, weight)
    row, code, value = features(marks)
    table = np.bincount(code, value * (root @ w[:-1])[row], minlength=1 << 18)
    return Model(table.astype(np.float32), float(w[-1]))


def _platt(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through scores and labels, with the smoothed targets of Platt (1999)."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([s, np.ones(len(s))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        grad = x.T @ (p - target) + 1e-3 * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-3 * np.eye(2), grad)
        size = np.abs(step).max()
        w -= step / max(1.0, size)
        if size < 1e-9:
            break
    return float(w[0]), float(w[1])


# ---- scores ------------------------------------------------------------------------------


def _scored(df: DataFrame, model: Model, out: str) -> DataFrame:
    """``df`` with the best word's score in place of the text, which is its first column."""
    held = df.sparkSession.sparkContext.broadcast((model.table, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*held.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(_batched(batch.column(0), scorer), pa.float64())], names=names)

    rest = df.drop(df.columns[0])
    names = [*rest.columns, out]
    return df.mapInArrow(run, rest.withColumn(out, F.lit(0.0)).schema)


def score(df: DataFrame, model: Model | None, keep: tuple[str, ...] | None = None, text: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default) with ``score``, the probability from 0 to 1 that the text is toxic.

    A null or empty text has the score of a text without any word near an insult.  Without a model all scores are 0.  Texts are
    read whole however long they are, repeated rows get the same score, and a column of ``df`` named ``out`` is replaced.
    """
    if model is None:
        return df.select(kept(df, keep, replaced=(out,))).select("row.*", F.lit(0.0).alias(out))
    raw = _scored(df.select(df[f"`{text}`"], kept(df, keep, replaced=(out,))), model, "s")
    logit = F.col("s") * model.slope + model.offset
    return raw.select("row.*", (1 / (1 + F.exp(-logit))).alias(out))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels outside the held-out fold."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    found = score(docs, fit(docs, read("labels")), ("doc_id",))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
