"""Runs of repeated words, whitening and language identification."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from cases import LONG, ODD, SF, A, B, by_id, documents, needs_tables, stored
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recspark.llm import language, periodic, whitening

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


# ---- operator 11


def plain_runs(words, least=24, power=3):
    """All runs by trying every period."""
    out, n = [], len(words)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                root = words[i : i + q]
                if not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def coded(docs):
    number = {w: i for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    return np.array([number[w] for d in docs for w in d], np.int32), np.cumsum([len(d) for d in docs], dtype=np.int64)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=45), st.integers(1, 9)), max_size=4), max_size=4), st.sampled_from([(24, 3), (6, 3), (9, 4)]))
def test_runs_are_those_of_every_period(parts, limits):
    docs = [[w for root, times in d for w in root * times] for d in parts]
    word, ends = coded(docs)
    assert periodic.runs_of(word, ends, *limits) == [plain_runs(d, *limits) for d in docs]


def test_runs_of_long_periods_and_nested_ones():
    rng = np.random.default_rng(5)
    deep = [1]
    for _ in range(6):
        deep = deep * 3 + [int(rng.integers(2, 9))]
    docs = [list(range(700)) * 3 + [5] + [7] * 4000, deep, [0, 1] * 3000 + [0], list(rng.integers(0, 2, 400)) * 4]
    word, ends = coded(docs)
    assert periodic.runs_of(word, ends) == [plain_runs(d) for d in docs]
    assert periodic.least_overlap() == 16


def planted(doc_id, words):
    if doc_id is None or not words or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g = zlib.crc32(str(doc_id).encode()) // 10
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_runs(doc_id, text):
    words = planted(doc_id, BLANKS.findall(text or ""))
    word, ends = coded([words])
    runs = plain_runs(words) if len(words) <= 800 else periodic.runs_of(word, ends)[0]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in lost)),
    )


def check_runs(spark, folder):
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in periodic.op11_periodic_runs(spark, folder).collect())
    assert got == Counter((r.doc_id, *expected_runs(*r)) for r in texts)
    return got


def test_runs_of_odd_documents(spark, tmp_path):
    more = [(i, f"{A} {B} " * (i % 5), "en", "s") for i in range(100, 160)]
    check_runs(spark, stored(spark, tmp_path, documents=documents(spark, ODD + more)))
    empty = stored(spark, tmp_path / "none", documents=documents(spark).limit(0))
    assert periodic.op11_periodic_runs(spark, empty).count() == 0


@needs_tables
def test_runs_of_the_documents(spark):
    assert sum(r[1] > 0 for r in check_runs(spark, SF)) > 10


def test_runs_keep_all_columns(spark):
    df = documents(spark).withColumn("Runs", F.lit(1)).withColumn("collapsed", F.lit(2)).withColumn("start", F.lit(3))
    rows = periodic.find_runs(df).collect()
    assert len(rows) == len(ODD) and rows[0]["start"] == 3
    (r,) = [r for r in rows if r.doc_id == 9]
    assert r.collapsed == LONG and r.runs == []
    hot = spark.range(3000).select("id", F.lit("a b c " * 50).alias("text"))
    assert {(r.collapsed, tuple(r.runs[0])) for r in periodic.find_runs(hot).collect()} == {("a b c", (0, 150, 3))}
    with pytest.raises(ValueError):
        periodic.find_runs(df, power=2)


# ---- operator 12


def plain_whitening(vectors):
    """The fit in exact numbers, its eigenvalues by another method."""
    xs = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    centred = [[Fraction(n * x[i] - sums[i], n) for i in range(d)] for x in xs]
    cov = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)])
    return n, sums, cov


def good(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check_whitening(rows, vectors, dim):
    n, sums, cov = plain_whitening([v for v in vectors.values() if good(v) and len(v) == dim])
    values, bases = np.linalg.eigh(cov)
    values, bases = values[::-1], bases[:, ::-1]
    rank = min(16, int((values > 1e-9 * values[0]).sum()))
    held = defaultdict(dict)
    for r in rows:
        held[r.vec_id][r.component] = r
    assert set(held) == {i for i, v in vectors.items() if good(v) and len(v) == dim}
    z = {}
    for i, per in held.items():
        x = [math.floor(64 * c) + 1_000_000 for c in vectors[i]]
        assert sorted(per) == list(range(1, rank + 1))
        for k, r in per.items():
            assert (r.n, r.deviation) == (n, sum((n * a - s) ** 2 for a, s in zip(x, sums)))
            assert abs(r.explained - values[k - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9
        z[i] = [per[k].whitened for k in sorted(per)]
    ids = list(z)
    centred = np.array([[float(Fraction(n * (math.floor(64 * c) + 1_000_000) - s, n)) for c, s in zip(vectors[i], sums)] for i in ids])
    mine, theirs = np.array([z[i] for i in ids]), centred @ bases[:, :rank] / np.sqrt(values[:rank])
    gaps = np.abs(np.subtract.outer(values[:rank], values)) + np.eye(rank, len(values)) * values[0]
    for k in np.flatnonzero(gaps.min(1) > 1e-6 * values[0]):  # only such a component is fixed but for its sign
        assert min(np.abs(mine[:, k] - theirs[:, k]).max(), np.abs(mine[:, k] + theirs[:, k]).max()) < 1e-6


@needs_tables
def test_whitening_matches_another_method(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening(whitening.op12_whitening(spark, SF).collect(), {r.vec_id: r.embedding for r in rows}, 64)


def test_whitening_of_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    made = {i: [*rng.normal(size=4).tolist(), 0.5, float(i % 2)] for i in range(40)}
    for v in made.values():
        v[3] = v[0]  # a dimension that adds no rank
    made |= {50: None, 51: [1.0, None, 0.0, 0.0, 0.0, 0.0], 52: [math.nan] * 6, 53: [math.inf] * 6, 54: [], 55: [1.0, 2.0], 56: list(made[0]), None: list(made[1])}
    schema = "vec_id long, embedding array<double>, label int, component string, `row` string"
    df = spark.createDataFrame([(i, v, 1, "c", "r") for i, v in made.items()], schema)
    check_whitening(whitening.op12_whitening(spark, stored(spark, tmp_path, embeddings=df)).collect(), made, 6)
    full = whitening.whiten(df)
    assert full.columns == ["vec_id", "embedding", "label", "row", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    again = df.unionAll(df)
    key = ["vec_id", "component"]
    assert whitening.whiten(again).count() == 2 * full.count()
    assert {tuple(r[c] for c in [*key, "n", "deviation"]) for r in whitening.whiten(again).collect()} == {tuple(r[c] for c in [*key, "n", "deviation"]) for r in full.collect()}
    for rows in (df.limit(0), df.where("vec_id = 3"), df.where("vec_id in (0, 56)"), df.where("vec_id in (50, 54)")):
        assert whitening.whiten(rows).collect() == []


def test_whitening_stays_exact_for_large_numbers(spark):
    made = {i: [1e12 * (-1) ** i, float(i), 1e300 if i == 3 else 0.0] for i in range(9)}
    df = spark.createDataFrame(list(made.items()), "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).collect()
    assert {r.deviation for r in rows} == {None} and {r.n for r in rows} == {9}


def test_factor_and_rotation():
    rng = np.random.default_rng(1)
    m = rng.normal(size=(30, 12)) * 10.0 ** -np.arange(12)
    a = (m.T @ m).astype(np.longdouble)
    l, p = whitening.pivoted_cholesky(a)
    assert np.abs(l @ l.T - a[np.ix_(p, p)]).max() < 1e-12 and np.allclose(np.triu(l, 1), 0)
    values, vectors = whitening.eigen(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.allclose((vectors * values) @ vectors.T, a.astype(float), atol=1e-12)
    assert np.allclose(values[:5], np.linalg.svd(m, compute_uv=False)[:5].astype(float) ** 2, rtol=1e-9)


# ---- operator 13


def plain_language(docs, learn, longest=5):
    """The same scores worked out one word at a time."""
    runs = lambda t: re.split(r"[^a-zA-ZÀ-ÖØ-öø-ÿĀ-ɏ]+", unicodedata.normalize("NFC", t or "").lower())
    split = lambda t: [w[i : i + 32] for w in runs(t) for i in range(0, len(w), 32)]
    langs = sorted({d[2] for d in docs if learn(d[0]) and d[2] is not None})
    words = {x: Counter() for x in langs}
    for i, t, x in docs:
        if learn(i) and x is not None:
            words[x].update(split(t))
    total = {x: sum(c.values()) for x, c in words.items()}
    parts = lambda w, s: [f" {w} "[i : i + s] for i in range(len(w) + 3 - s)]
    grams = {s: {x: Counter() for x in langs} for s in range(1, longest + 1)}
    for x, c in words.items():
        for w, k in c.items():
            for s in grams:
                for g in parts(w, s):
                    if g != " ":
                        grams[s][x][g] += k
    sums = {s: {x: sum(c.values()) for x, c in per.items()} for s, per in grams.items()}
    log = lambda per, all_, key: [round(math.log(per[x][key] / all_[x] if per[x][key] else 0.5 / max(all_.values())) * language.UNIT) for x in langs]

    def vector(w):
        if any(w in c for c in words.values()):
            return log(words, total, w)
        for s in range(longest, 0, -1):
            found = [log(grams[s], sums[s], g) for g in parts(w, s) if any(g in c for c in grams[s].values())]
            if found:
                return [int(sum(v) / len(found)) for v in zip(*found)]
        return None

    order = sorted(range(len(langs)), key=lambda i: (-total[langs[i]], i))
    out = {}
    for i, t, _ in docs:
        own = split(t)
        known = [v for v in map(vector, own) if v]
        if not own or not langs:
            out[i] = ("und", 0.0)
            continue
        sums_ = [sum(v[k] for v in known) / language.UNIT / math.sqrt(max(1, len(known))) for k in order]
        top = max(range(len(order)), key=lambda k: (sums_[k], -k))
        out[i] = (langs[order[top]], 1 / sum(math.exp(s - sums_[top]) for s in sums_))
    return out


TALK = [
    (20, "the cat and the dog", "en"), (21, "le chat et le chien", "fr"), (22, "der Hund und die Katze", "de"), (23, "the CATS andy 123", None),
    (24, "chatte", "xx"), (25, "q", None), (26, "123 !!", "en"), (27, "日本", None), (28, "É" + "́" + "té " + "x" * 100, None), (29, "und" * 400, None),
]


@pytest.mark.parametrize("block_chars", [1, 60, language.BLOCK_CHARS])
def test_scores_are_those_of_a_plain_version(spark, block_chars, monkeypatch):
    if block_chars == 1:
        monkeypatch.setattr(language, "HOT", 20)  # so that some words are spread over several keys
    rows = [(i, t, x) for i, t, x in TALK if "́" not in t] + [(i, r[1], r[2]) for i, r in enumerate(ODD, 100) if r[0] not in (9, 12)]
    learn = lambda i: i not in (23, 24, 25, 28, 29, 111)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    got = language.identify(df, ~F.col("doc_id").isin(23, 24, 25, 28, 29, 111), block_chars=block_chars)
    want = plain_language([r for r in rows if r[1] != "日本"], learn)
    for r in got.collect():
        if r.doc_id == 27:
            assert r.lang_pred in ("de", "en", "es", "fr")  # letters, but none that was learned
            continue
        assert r.lang_pred == want[r.doc_id][0], r
        assert abs(r.score - want[r.doc_id][1]) < 1e-5


def test_odd_documents_have_a_language_or_none(spark):
    docs = documents(spark).withColumn("Lang_pred", F.lit(1)).withColumn("word", F.lit("w")).withColumn("block", F.lit(1))
    rows = language.identify(docs, F.lit(True)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.word == "w" for r in rows)
    assert {r.lang_pred for r in rows if not r.text or r.text.isspace()} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 4, 9)} == {"en"}
    for none in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        assert {r.lang_pred for r in language.identify(none, F.lit(True)).collect()} <= {"und"}
    assert {r.lang_pred for r in language.identify(docs, F.lit(None).cast("boolean")).collect()} == {"und"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 30000)), max_size=60))
def test_places_read_back_from_gaps(pairs):
    pairs = sorted(pairs)
    word, place = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    gaps, sizes = language._opened(language._shut(*language._gaps(word, place, 6)))
    starts = np.cumsum(sizes) - sizes
    row, back = language._places(gaps, starts, sizes)
    assert list(zip(row.tolist(), back.tolist())) == pairs
    some = np.array([4, 1])
    row, back = language._places(gaps, starts[some], sizes[some])
    assert list(zip(some[row].tolist(), back.tolist())) == [p for w in some for p in pairs if p[0] == w]


@needs_tables
def test_languages_of_the_documents(spark):
    rows = language.op13_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == len(lang)
    out = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
