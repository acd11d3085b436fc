"""Language identification, words first (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..workspace import written
from .common import kept

#: Letters of the longest character n-grams that unseen words fall back to; a blank stands before and after a word.
LONGEST = 5
#: A longer run of letters is cut into words of so many.
WORD_LETTERS = 32
#: Characters after which a block of documents is closed, and its most documents.
BLOCK_CHARS, BLOCK_DOCS = 24_000_000, 50_000
#: Logarithms are kept as whole numbers of two bytes, this many to one, so that sums are the same in any order.
UNIT = 1_000
#: A token's step from the token before is a byte below this one; the bytes from it on stand for multiples of it that come before.
STEP = 200
#: Words of at least this share of all questions of blocks are spread over several keys; so there are at most as many.
HOT = 10_000

#: Rows of a block: the places of its tokens (kind 0), its documents (1) and, with ``place`` as their number, its distinct words (2).
_BLOCKS = "block long, kind int, place int, row {row}, word string, data binary, counts map<int,long>"


# ---- blocks ------------------------------------------------------------------------------


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, lower case, and the place of the text that each is of."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.utf8_normalize(texts, "NFC")), r"[^\pL]+")
    place = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    held = pc.not_equal(words, "")
    words, place = words.filter(held), place[held.to_numpy(zero_copy_only=False)]
    long = pc.greater(pc.utf8_length(words), WORD_LETTERS).to_numpy(zero_copy_only=False)
    if long.any():
        cut = [(w[i : i + WORD_LETTERS], p) for w, p in zip(words.filter(pa.array(long)).to_pylist(), place[long]) for i in range(0, len(w), WORD_LETTERS)]
        words = pa.concat_arrays([words.filter(pa.array(~long)), pa.array([w for w, _ in cut], words.type)])
        place = np.append(place[~long], np.array([p for _, p in cut], np.int32))
    return words, place


def _gaps(word: np.ndarray, place: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each word's tokens: for each its step from the token before, as up to two bytes where it is not very long.

    ``word`` and ``place`` are sorted.  Also returned: how many bytes each word has.
    """
    step = np.diff(place, prepend=np.zeros(1, place.dtype))
    first = np.append(True, word[1:] != word[:-1]) if len(word) else np.array([], bool)
    step[first] = place[first]
    far, rest = np.divmod(step // STEP, 256 - STEP)
    sizes = far + (rest > 0) + 1
    ends = np.cumsum(sizes)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = step % STEP
    some = rest > 0
    out[ends[some] - 2] = STEP - 1 + rest[some]
    return out, np.bincount(word, sizes, n_words).astype(np.int64)


def _places(gaps: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse: the word, of those whose bytes lie at ``starts``, that each token is of, and its place."""
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(sizes)), sizes)
    gaps = gaps[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(word))]
    hit = gaps < STEP
    upto = np.cumsum(np.where(hit, gaps, (gaps.astype(np.int64) - (STEP - 1)) * STEP), dtype=np.int64)
    before = np.append(0, upto)[ends - sizes]
    return word[hit], (upto - before[word])[hit]


def _shut(gaps: np.ndarray, sizes: np.ndarray) -> bytes:
    """All words' bytes as one value, compressed."""
    data = b"".join([np.int64(len(sizes)).tobytes(), sizes.astype(np.int32).tobytes(), gaps.tobytes()])
    return np.int64(len(data)).tobytes() + pa.compress(data, "zstd", asbytes=True)


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    m = int.from_bytes(data[:8], "little")
    return np.frombuffer(data, np.uint8)[8 + 4 * m :], np.frombuffer(data, np.int32, m, 8).astype(np.int64)


def _block_rows(number: int, rows: pa.Array, texts: pa.Array, codes: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A block as a row per document, whose ``data`` says whether it has letters, one of all tokens' places, and a row per distinct word."""

    def out(n: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(n, number))
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    n = len(texts)
    words, place = _words(texts)
    letters = np.bincount(place, minlength=n) > 0
    yield out(n, kind=pa.array(np.full(n, 1, np.int32)), place=pa.array(np.arange(n, dtype=np.int32)), row=rows, data=pa.array([b"\1" if x else b"\0" for x in letters], pa.binary()))
    coded = words.dictionary_encode()
    del words
    names = coded.dictionary
    m = len(names)
    if not m:
        return
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    key = rank[coded.indices.to_numpy(zero_copy_only=False)]
    del coded
    key *= n
    key += place
    key.sort()
    w, place = (key // n).astype(np.int32), (key % n).astype(np.int32)
    del key
    yield out(1, kind=pa.array([0], pa.int32()), data=pa.array([_shut(*_gaps(w, place, m))], pa.binary()))
    code = codes[place]
    learned = w[code >= 0].astype(np.int64)
    learned <<= 31
    learned += code[code >= 0]
    del w, place, code
    learned, counts = np.unique(learned, return_counts=True)
    own = np.searchsorted(learned, np.arange(m + 1) << 31)
    maps = pa.MapArray.from_arrays(pa.array(own.astype(np.int32)), pa.array((learned % (1 << 31)).astype(np.int32)), pa.array(counts.astype(np.int64)))
    found = out(
        m, kind=pa.array(np.full(m, 2, np.int32)), place=pa.array(np.arange(m, dtype=np.int32)), word=names.take(pa.array(order)), counts=maps.cast(schema.field("counts").type)
    )
    for at in range(0, m, 50_000):
        yield found.slice(at, 50_000)


def _index(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over ``row``, ``text``, ``code``: the rows of blocks of documents.  Block numbers are the task's own."""
        number, held, chars = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                to = int(np.searchsorted(sizes, done + block_chars - chars)) + 1  # the document that fills the block goes in
                to = min(to, batch.num_rows, at + BLOCK_DOCS - sum(h.num_rows for h in held))
                held.append(batch.slice(at, to - at))
                chars += int(sizes[to - 1] - done)
                at = to
                if chars >= block_chars or sum(h.num_rows for h in held) >= BLOCK_DOCS:
                    yield from _block_of(number, held)
                    number, held, chars = number + 1, [], 0
        if held:
            yield from _block_of(number, held)

    return run


def _block_of(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, texts, codes = (pa.chunked_array([h.column(i) for h in held]).combine_chunks() for i in range(3))
    types = [pa.int64(), pa.int32(), pa.int32(), rows.type, pa.string(), pa.binary(), pa.map_(pa.int32(), pa.int64())]
    names = ["block", "kind", "place", "row", "word", "data", "counts"]
    return _block_rows(number, rows, texts, codes.to_numpy(zero_copy_only=False), pa.schema(list(zip(names, types))))


# ---- the model ---------------------------------------------------------------------------


def _logs(counts: Column, totals: list[int]) -> Column:
    """Log frequencies by language; a language without the item has half a count in the largest."""
    none = F.lit(0.5 / max(totals))
    each = [F.when(F.get(counts, i) > 0, F.get(counts, i) / F.lit(float(max(1, t)))).otherwise(none) for i, t in enumerate(totals)]
    return F.array(*[F.greatest(F.round(F.log(x) * UNIT), F.lit(-32767.0)).cast("int") for x in each])


def _bytes(logs: Column, n: int) -> Column:
    """Two bytes for each of ``n`` whole numbers from 0 down."""
    return F.unhex(F.concat(*[F.lpad(F.hex(-F.get(logs, i)), 4, "0") for i in range(n)]))


def _totals(df: DataFrame, n: int, by: str | None = None) -> dict:
    rows = (df.groupBy(by) if by else df.groupBy()).agg(*[F.sum(F.get("counts", i)).alias(f"n{i}") for i in range(n)]).collect()
    return {r[by] if by else None: [r[f"n{i}"] or 0 for i in range(n)] for r in rows}


def _grams(word: Column, size: Column) -> Column:
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.when(
        F.length(padded) >= size,
        F.transform(F.sequence(F.lit(1), F.length(padded) - size + 1), lambda i: F.substring(padded, i, size)),
    ).otherwise(F.array().cast("array<string>"))


def _word_vectors(words: DataFrame, n: int, longest: int) -> tuple[DataFrame, list[int]]:
    """``word``, ``logs`` of every word of ``words`` (``word``, ``counts``) that the model can say something on.

    A word that the learned documents have is scored by its own frequencies.  Others are scored by the mean of their n-grams
    of the greatest length of which any is known.
    """
    sum_of = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    seen = words.where(sum_of(F.col("counts")) > 0)
    totals = _totals(seen, n).get(None, [0] * n)
    out = seen.select("word", _logs(F.col("counts"), totals).alias("logs"))
    sizes = F.array(*[F.lit(s) for s in range(1, longest + 1)])
    grams = seen.select("counts", F.explode(F.flatten(F.transform(sizes, lambda s: _grams(F.col("word"), s)))).alias("gram"))
    sums = [F.sum(F.get("counts", i)).alias(f"c{i}") for i in range(n)]
    known = grams.groupBy("gram").agg(*sums).where("gram <> ' '")
    known = written(known.select("gram", F.length("gram").alias("size"), F.array(*[f"c{i}" for i in range(n)]).alias("counts")), "grams")
    per_size = _totals(known, n, "size")
    left = written(words.where(sum_of(F.col("counts")) == 0).select("word"), "unseen")
    for size in range(longest, 0, -1):
        if size not in per_size:
            continue
        logs = known.where(F.col("size") == size).select("gram", _logs(F.col("counts"), per_size[size]).alias("logs"))
        asked = left.select("word", F.explode(_grams(F.col("word"), F.lit(size))).alias("gram"))
        means = [F.expr(f"cast(sum(logs[{i}]) div count(1) as int)") for i in range(n)]
        found = written(asked.join(logs, "gram").groupBy("word").agg(F.array(*means).alias("logs")), f"grams{size}")
        out = out.unionByName(found)
        if size > 1:
            left = written(left.join(found, "word", "left_anti"), "unseen")
    return out, totals


# ---- documents ---------------------------------------------------------------------------


def _scored(n: int, order: list[int], langs: list[str]):
    """Over the rows of blocks by kind, words with their logarithms: each document with its language and how sure that is."""

    def finish(rows: list[pa.RecordBatch], scores: np.ndarray, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        letters = [x == b"\1" for b in rows for x in b.column("data").to_pylist()]
        mean = scores[:, order] / UNIT / np.sqrt(np.maximum(tokens, 1))[:, None]
        best = mean.argmax(1)
        sure = 1 / np.exp(mean - mean.max(1, keepdims=True)).sum(1)
        names = pa.array([langs[order[b]] if has else "und" for b, has in zip(best, letters)], pa.string())
        out = pa.RecordBatch.from_arrays(
            [pa.chunked_array([b.column("row") for b in rows]).combine_chunks(), names, pa.array(np.where(letters, sure, 0.0))], names=["row", "lang_pred", "score"]
        )
        for at in range(0, out.num_rows, 10_000):
            yield out.slice(at, 10_000)

    def add(words: pa.RecordBatch, gaps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, scores: np.ndarray, tokens: np.ndarray) -> None:
        at = words.column("place").to_numpy(zero_copy_only=False).astype(np.int64)
        logs = -np.frombuffer(b"".join(words.column("data").to_pylist()), ">u2").astype(np.int64).reshape(-1, n)
        ends = np.cumsum(sizes[at])
        cuts = [0, *(np.flatnonzero(np.diff(ends // (1 << 20))) + 1).tolist(), len(at)]  # about a million tokens at once
        for a, b in zip(cuts[:-1], cuts[1:]):
            word, place = _places(gaps, starts[at[a:b]], sizes[at[a:b]])
            tokens += np.bincount(place, minlength=len(tokens))
            for i in range(n):
                scores[:, i] += np.bincount(place, logs[a:b][word, i], len(tokens)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, gaps, scores, tokens = None, [], None, None, None
        for batch in batches:
            numbers, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if a == b:
                    continue
                if numbers[a] != block:
                    if rows:
                        yield from finish(rows, scores, tokens)
                    block, rows, gaps = numbers[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    gaps, sizes = _opened(part.column("data")[0].as_py())
                    starts = np.cumsum(sizes) - sizes
                elif kinds[a] == 1:
                    rows.append(part)
                    size = sum(r.num_rows for r in rows)
                    scores, tokens = np.zeros((size, n), np.int64), np.zeros(size, np.int64)
                else:
                    add(part, gaps, starts, sizes, scores, tokens)
        if rows:
            yield from finish(rows, scores, tokens)

    return run


def identify(
    df: DataFrame, learn: Column | str, text: str = "text", lang: str = "lang", keep: tuple[str, ...] | None = None, longest: int = LONGEST,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``df`` (columns ``keep``, all by default) with ``lang_pred`` and ``score``.

    A word-first back-off model (as HeLI, Jauhiainen and others, 2016) is learned from the text and ``lang`` of the rows for which
    ``learn`` holds and ``lang`` is not null.  Words are runs of letters in lower case.  A word that the learned texts have
    is scored by the log of its share of each language's words; another one by the mean log share of its longest known character
    n-grams, from ``longest`` letters down to one.  An item that a language lacks counts as half an occurrence in the largest.
    ``lang_pred`` is the language of the greatest sum (ties: the one with most learned words, then the first by code point); ``und``
    with score 0 where the text is null or has no letter, or where nothing was learned.  ``score`` is a softmax of the sums over the root of the
    number of words: 0 to 1, more the longer and clearer a text is.  Equal texts get equal results, and repeated rows stay.
    Columns that are already called ``lang_pred`` or ``score`` are replaced.

    Every block of documents asks for each of its distinct words once, and the answers go back to it: no text is shuffled, and
    the model is never in one place.  Words that very many blocks ask for are spread over several keys.
    """
    keep = tuple(c for c in (df.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score"))
    learn = F.expr(learn) if isinstance(learn, str) else learn
    taught = F.coalesce(learn, F.lit(False)) & df[f"`{lang}`"].isNotNull()
    names = df.where(taught).select(df[f"`{lang}`"].cast("string").alias("lang"))
    langs = sorted(r.lang for r in names.distinct().collect())
    row = kept(df, keep)
    if not langs:
        return df.select(row).select("row.*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    n = len(langs)
    code = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in langs]), F.when(taught, df[f"`{lang}`"].cast("string"))) - 1, F.lit(-1)).cast("int")
    source = df.select(row, F.coalesce(df[f"`{text}`"], F.lit("")).alias("text"), code.alias("code"))
    kind = source.schema["row"].dataType
    blocks = written(source.mapInArrow(_index(block_chars), _BLOCKS.format(row=kind.simpleString())), "blocks")
    asked = blocks.where("kind = 2").select("block", "place", "word", "counts")

    sums = [F.coalesce(F.sum(F.try_element_at("counts", F.lit(i))), F.lit(0).cast("long")) for i in range(n)]
    words = written(asked.groupBy("word").agg(F.array(*sums).alias("counts"), F.count(F.lit(1)).alias("asked")), "words")
    vectors, totals = _word_vectors(words, n, longest)
    vectors = vectors.select("word", _bytes(F.col("logs"), n).alias("logs"))
    share = (words.agg(F.sum("asked")).first()[0] or 0) / HOT
    hot = words.where(F.col("asked") > max(share, 1)).select("word", F.ceil(F.col("asked") / max(share, 1)).cast("int").alias("keys"))
    hot = written(hot, "hot")  # at most HOT words of WORD_LETTERS letters
    spread = lambda d, part: d.join(F.broadcast(hot), "word", "left").withColumn("part", part)
    answers = spread(vectors, F.explode(F.sequence(F.lit(0), F.coalesce("keys", F.lit(1)) - 1))).select("word", "part", "logs")
    asking = spread(asked.drop("counts"), F.coalesce(F.pmod(F.xxhash64("block"), F.col("keys")).cast("int"), F.lit(0)))
    met = asking.join(answers, ["word", "part"]).select("block", F.lit(2).alias("kind"), "place", F.col("logs").alias("data"))
    both = blocks.where("kind < 2").select("block", "kind", "place", "row", "data").unionByName(met, allowMissingColumns=True)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = sorted(range(n), key=lambda i: (-totals[i], i))
    schema = T.StructType([T.StructField("row", kind), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sorted_ = both.repartition(parts, "block").sortWithinPartitions("block", "kind", "place")
    return sorted_.mapInArrow(_scored(n, order, langs), schema).select("row.*", "lang_pred", "score")


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return identify(docs, fold != 2, keep=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")
