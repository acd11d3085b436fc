"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..plans.ranges import BUCKET, add_range, key_ranges, sample_for_sketch
from ..workspace import written
from .common import components, packed

#: Words per shingle and the most bits in which linked fingerprints differ.
SHINGLE, MAX_BITS = 4, 4
#: Widths of the three segments of a fingerprint; each is a word of the Golay code of length 23, padded with zeros.
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the binary Golay code (23, 12).
GENERATOR = 0xC75
#: Rows of one key that a task compares with each other at once; longer runs get the distributed comparison as well.
RUN = 1024
#: Keys of a fingerprint, about, and the fingerprints whose keys place the cuts between ranges of keys.  They decide balance, never the result.
KEYS, CUT_PRINTS = 180, 20_000


# ---- fingerprints ----------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if it is set in more than half the XXH64 hashes (seed 42) of the text's word shingles.

    A-Z count as a-z, words end at white space, repeated shingles count each time, and a text of fewer words is one shingle.
    No words: 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    stops = ends[size - 1 :].tolist()
    for at in range(0, n, 1 << 14):
        h = np.array([digest(line[a:b], 42) for a, b in zip(starts[at : at + (1 << 14)], stops[at : at + (1 << 14)])], np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of its text as a signed 64-bit ``out``, in place of the text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column(0)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints)], names=names)

    rest = df.drop(text)
    names = [*rest.columns, out]
    schema = rest.withColumn(out, F.lit(0).cast("long")).schema
    return df.select(text, *rest.columns).mapInArrow(run, schema)


# ---- keys ------------------------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    out = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        out = np.where((out >> bit) & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


def golay_table() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of at most 4 bits that have it (1 or 6 of them), and how many there are.

    The code is perfect: each word has exactly one codeword within 3 bits.  A word 3 bits away has 5 more at 4 bits.
    Two words at most 2 bits apart always have one codeword of these in common.
    """
    patterns = np.array([sum(1 << b for b in bits) for n in range(5) for bits in combinations(range(23), n)], np.int64)
    table, count = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    weights = np.array([int(p).bit_count() for p in patterns])
    lead = _syndrome(patterns)
    leader_weight = np.zeros(2048, np.int64)
    leader_weight[lead[weights < 4]] = weights[weights < 4]
    for p, s, w in zip(patterns, lead, weights):
        if w < 4 or leader_weight[s] == 3:
            table[s, count[s]] = p
            count[s] += 1
    return table, count


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints: positions in ``prints``, and one key each.

    With at most 4 errors in three segments either no segment has more than 2, and then the two fingerprints share a
    codeword near each of their segments: a key of three codeword numbers.  Or one segment has 3 or 4, and then the others
    have at most 1 together: a key of one segment as it is and a codeword number near the other.
    """
    table, count = _TABLE
    at, segments, numbers, sizes = 0, [], [], []
    for width in SEGMENTS:
        s = ((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
        syndrome = _syndrome(s)
        segments.append(s)
        numbers.append((s[:, None] ^ table[syndrome]) >> 11)
        sizes.append(count[syndrome])
        at += width
    rows, keys = [], []
    for picks in product(range(6), repeat=3):
        has = np.flatnonzero((sizes[0] > picks[0]) & (sizes[1] > picks[1]) & (sizes[2] > picks[2]))
        rows.append(has)
        keys.append(numbers[0][has, picks[0]] << 24 | numbers[1][has, picks[1]] << 12 | numbers[2][has, picks[2]])
    for kind, (exact, near) in enumerate(((i, j) for i in range(3) for j in range(3) if i != j), 1):
        for pick in range(6):
            has = np.flatnonzero(sizes[near] > pick)
            rows.append(has)
            keys.append(kind << 36 | segments[exact][has] << 12 | numbers[near][has, pick])
    return np.concatenate(rows), np.concatenate(keys)


_TABLE = golay_table()


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 2048):
            part = prints[at : at + 2048]
            rows, keys = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], names=["key", "fp"])


# ---- links -----------------------------------------------------------------------------


def _tied(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the smallest that it reaches through links among ``prints``."""
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= max_bits
    label = np.arange(len(prints))
    while True:
        new = np.where(linked, label[None, :], len(prints)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return prints[label]
        label = new


def _runs(max_bits: int, run: int):
    """Over rows sorted by key: links inside each key's run, and the rows of runs that may go on elsewhere."""

    def several(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) + 1
        starts = np.append(0, ends[:-1])
        sizes = ends - starts
        two = starts[sizes == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        yield 0, a[near], b[near]
        for s, e in zip(starts[sizes > 2], ends[sizes > 2]):
            for at in range(s, e, run):
                part = prints[at : min(e, at + run)]
                root = _tied(part, max_bits)
                own = part != root
                yield 0, part[own], root[own]
            if e - s > run:
                yield 1, keys[s:e], prints[s:e]

    def out(found: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for kind in (0, 1):
            pairs = [np.stack([a.view(np.int64), b.view(np.int64)], 1) for k, a, b in found if k == kind and len(a)]
            if pairs:
                rows = np.unique(np.concatenate(pairs), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), kind, np.int32)), pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], names=["kind", "a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, first, long = np.array([], np.int64), np.array([], np.uint64), None, None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(keys):
                continue
            first = keys[0] if first is None else first
            cut = np.searchsorted(keys, keys[-1])  # the last run may go on in the next batch
            found = list(several(keys[:cut], prints[:cut]))
            if len(keys) - cut > 1 << 16:  # a long run: compare what is here, and hand its rows on
                found += [x for x in several(keys[cut:-run], prints[cut:-run]) if x[0] == 0]
                cut, long = len(keys) - run, keys[-1]
            edge = (keys[:cut] == first) | (keys[:cut] == long)
            if edge.any():
                found.append((1, keys[:cut][edge], prints[:cut][edge]))
            yield from out(found)
            keys, prints = keys[cut:], prints[cut:]
        if len(keys):
            yield from out([*several(keys, prints), (1, keys, prints)])

    return walk


def _across(rows: DataFrame, labels: DataFrame, max_bits: int) -> DataFrame:
    """Links between rows ``key``, ``fp`` of one key whose components differ.

    Each component of a key has a pivot and a radius.  Two components are compared row by row only if their pivots are
    no farther apart than both radii and ``max_bits`` together; others cannot hold a link.
    """
    tied = written(rows.join(labels, rows["fp"] == labels["node"], "left").select("key", "fp", F.coalesce("root", "fp").alias("comp")).distinct(), "rows")
    pivots = written(tied.groupBy("key", "comp").agg(F.min("fp").alias("pivot")), "pivots")
    far = F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot")))
    parts = tied.join(pivots, ["key", "comp"]).groupBy("key", "comp").agg(F.first("pivot").alias("pivot"), F.max(far).alias("radius"))
    parts = written(parts, "pivots")
    several = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    parts = written(parts.join(several, "key", "left_semi"), "pivots")
    x, y = parts.alias("x"), parts.alias("y")
    close = F.bit_count(F.col("x.pivot").bitwiseXOR(F.col("y.pivot"))) <= F.col("x.radius") + F.col("y.radius") + max_bits
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") < F.col("y.comp")) & close).select("x.key", F.col("x.comp").alias("c"), F.col("y.comp").alias("d"))
    left = written(pairs, "pairs").join(tied.select("key", F.col("comp").alias("c"), F.col("fp").alias("a")), ["key", "c"])
    right = tied.select("key", F.col("comp").alias("d"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right, ["key", "d"]).where(near).select("a", "b").distinct()


def links(prints: DataFrame, max_bits: int = MAX_BITS, run: int = RUN) -> DataFrame:
    """``node``, ``root`` of the distinct fingerprints in ``prints`` (``fp``) that reach another: exact, no link is lost.

    Keys are cut into ranges by those of some fingerprints, and sorted with the fingerprint as second order, so a key that many share is split over tasks.  A task
    compares the rows of each key, up to ``run`` at a time, and passes on one link per row to the smallest it reaches.  Keys
    longer than that or cut by a range's end are finished by comparing components, not rows, across the cluster.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find fingerprints up to {MAX_BITS} bits apart")
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = written(prints.select("fp").distinct(), "distinct")
    total = distinct.count()
    # the keys of some fingerprints say where to cut; then the keys of all are made once, in n tasks: few bytes, but each row becomes about 180
    some = sample_for_sketch(distinct, total, rows=CUT_PRINTS).mapInArrow(_key_rows, "key long, fp long")
    ranges = key_ranges(some, ["key", "fp"], n, KEYS * min(total, CUT_PRINTS))
    keyed = distinct.repartition(n, F.xxhash64("fp")).mapInArrow(_key_rows, "key long, fp long")
    keyed = add_range(keyed, ranges).repartitionById(n, F.col(BUCKET)).select("key", "fp").sortWithinPartitions("key", "fp")
    found = written(keyed.mapInArrow(_runs(max_bits, run), "kind int, a long, b long"), "links")
    inside = found.where("kind = 0").select("a", "b")
    open_rows = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp")).distinct()
    tied = written(components(inside), "tied")
    more = written(_across(open_rows, tied, max_bits), "links")
    if more.isEmpty():
        return tied
    return components(tied.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``id``, ``fp`` with ``component``, the smallest id reachable.  ``prints`` is a written table.

    Equal fingerprints are one group however many they are; ids are counted per fingerprint before any join.
    A null id is never the smallest unless all are null.
    """
    tied = links(prints, max_bits)
    ids = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "ids")
    rooted = ids.join(tied, ids["fp"] == tied["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = written(rooted.join(least, "root").select("fp", "component"), "named")
    return prints.join(named, "fp").select("id", "fp", "component")


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` with the smallest id of their group, one for each group; columns unchanged.

    Of rows equal in id and text one stays; rows of one id and different groups are different documents.  Null ids come last.
    Texts without words share the fingerprint zero, so one stays.
    """
    doc, words = F.col(f"row.`{doc_id}`"), F.col(f"row.`{text}`")
    rows = packed(df).withColumn("id", F.struct(doc.isNull().alias("none"), doc.alias("doc"), F.xxhash64(words).alias("text")))
    prints = written(fingerprints(rows.select(words.alias("text"), "id"), shingle=shingle), "prints")
    verdict = groups(prints, max_bits).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first(F.col("id") == F.col("component")).alias("stays"))
    verdict = written(verdict, "verdict")
    # what goes and what repeats is mostly little, so that the texts need not be shuffled
    gone, repeated = verdict.where("not stays").select("id"), verdict.where("stays and n > 1").select("id")
    single = rows.join(gone, "id", "left_anti").join(repeated, "id", "left_anti")
    return single.union(rows.join(repeated, "id", "left_semi").dropDuplicates(["id"])).select("row.*")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", F.col("doc_id").alias("id"))
    found = groups(written(fingerprints(docs), "prints"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
