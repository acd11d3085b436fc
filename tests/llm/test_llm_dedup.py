"""Sketches, line dedup and SimHash groups."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import LONG, SF, A, B, by_id, documents, needs_tables, stored
from pyspark.sql import functions as F

from recspark.llm import common, lines, simhash, sketches


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "empty"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(100)],
        "star": [(7, i) for i in range(300)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "empty": [(None, 3), (4, 4), (None, None)],
    }[kind]
    got = dict(common.components(spark.createDataFrame(edges, "a int, b int")).collect())
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = roots({x for e in real for x in e}, real)
    assert got == {n: r for n, r in want.items() if n != r}


# ---- operator 2


def parts(text):
    return {p for p in re.split(r"\n|(?<=[.!?])[ \t]+", text or "") if p}


def like(a, b):
    return 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0


def check_sketches(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sketches.op2_document_sketch(spark, folder).collect()
    assert len(got) == len(rows)
    got = {(r.doc_id, r.edited_sha256): r for r in got}
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        r = got[d, hashlib.sha256(edited.encode()).hexdigest()]
        assert r.n_chars == len(t)
        assert r.near_edited == pytest.approx(like(parts(t), parts(edited))) and r.near_next == pytest.approx(like(parts(t), parts(following)))
        assert (r.fingerprint == r.edited_fingerprint) == (parts(t) == parts(edited))
        assert len(r.fingerprint) == 28 * 3 * sketches.WIDTH


@needs_tables
def test_sketches_match_sets(spark):
    check_sketches(spark, SF)


def test_sketches_of_odd_documents(spark, tmp_path):
    rows = [(i, t, "en", "s") for i, t in enumerate([A, A, "", None, B, "x", f"{A}\n{B}", ".\n".join(LONG.split()[:9000]), A[:40], " ", "é" * 5])] + [(None, B, None, None)]
    check_sketches(spark, stored(spark, tmp_path, documents=documents(spark, rows)))
    empty = stored(spark, tmp_path / "empty", documents=documents(spark, []))
    assert sketches.op2_document_sketch(spark, empty).count() == 0
    one = stored(spark, tmp_path / "one", documents=documents(spark, [(5, "abc. def", "en", "s")]))
    assert sketches.op2_document_sketch(spark, one).first().near_next == 1.0


def test_peeling_gives_the_digests_back(spark):
    left, right = list(range(1, 400)), list(range(3, 402))
    pairs = spark.createDataFrame([(1, left, right), (2, [], []), (3, [5], []), (4, [-1, 2], [2, -(2**63)])], "id int, l array<long>, r array<long>")
    got = {r.id: r["l-r"] for r in sketches.compare(pairs, [("l", "r")]).collect()}
    assert sorted(got[1].left) == [1, 2] and sorted(got[1].right) == [400, 401]
    assert got[2] == ([], []) and got[3] == ([5], []) and got[4] == ([-1], [-(2**63)])


def test_a_sketch_that_is_too_small_says_so(spark):
    df = spark.createDataFrame([(list(range(200)), [])], "l array<long>, r array<long>")
    cells = sketches.subtract(sketches.table(F.col("l"), 8), sketches.table(F.col("r"), 8))
    assert df.select(sketches.peel(cells, 8).alias("d")).first().d is None


# ---- operator 4


def kept_lines(rows):
    """Brute force over all pairs of distinct lines."""
    order = []
    for _, t in rows:
        order += [x for x in (t or "").split("\n") if x.strip()]
    order = list(dict.fromkeys(order))
    sets = [lines.shingles(x) for x in order]
    links = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = roots(range(len(order)), links)
    place, seen, out = {x: root[i] for i, x in enumerate(order)}, set(), []
    for d, t in rows:
        held = []
        for x in (t or "").split("\n"):
            if x.strip():
                if place[x] in seen:
                    continue
                seen.add(place[x])
            held.append(x)
        out.append((d, "\n".join(held)))
    return out


@needs_tables
def test_lines_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = by_id(lines.op4_line_dedup(spark, SF))
    for d, t in kept_lines([(r.doc_id, r.text) for r in rows]):
        assert got[d].kept_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[d].n_kept == sum(bool(x.strip()) for x in t.split("\n"))


def variants(base, n, seed=1):
    """Texts that differ from the one before by a letter or two: a long chain of similar lines."""
    rng, out, words = random.Random(seed), [], base.split()
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i] = "".join(rng.choice("abcdefgh") for _ in range(len(words[i])))
        out.append(" ".join(words))
    return out


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = " ".join(f"{w}{i}" for i, w in enumerate(A.split() * 3))
    rows = [(i, t) for i, t in enumerate(variants(base, 300))] + [(1000 + i, t) for i, t in enumerate(variants(B, 40, 2))]
    docs = spark.createDataFrame([(d, t, len(t)) for d, t in rows], "doc_id int, text string, n_chars int")
    got = {(r.doc_id, r.text) for r in lines.dedup_lines(docs).collect()}
    assert got == {(d, t) for d, t in kept_lines(rows) if t.strip()}


def test_groups_too_large_for_a_task_are_compared_in_blocks(spark, monkeypatch):
    base = " ".join(f"{w}{i}" for i, w in enumerate(A.split() * 3))
    rows = [(i, t) for i, t in enumerate(variants(base, 120))]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    want = {(d, t) for d, t in kept_lines(rows) if t.strip()}
    monkeypatch.setattr(lines, "GROUP", 10)
    assert {(r.doc_id, r.text) for r in lines.dedup_lines(docs).collect()} == want


def test_lines_of_odd_documents(spark):
    docs = documents(spark)
    got = lines.dedup_lines(docs)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = got.collect()
    text = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert text[1] == A and 2 not in text and 3 not in text and text[4] == B and text[5] == "" and text[6] is None
    assert text[8] == " \t\n\n " and 11 not in text and text[9] == LONG
    assert sum(r.doc_id == 13 for r in rows) == 2  # rows equal in id and text are one document
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    a = [lines.plain(x) for x in variants(" ".join(f"{w}{i}" for i, w in enumerate(A.split() * 5)), 12)]
    s = lines.signatures(a)
    for i in range(1, 12):
        x, y = lines.shingles(a[0]), lines.shingles(a[i])
        assert abs((s[0] == s[i]).mean() - len(x & y) / len(x | y)) < 0.2
    long = lines.signatures([LONG.lower() * 3, "ab", ""])
    assert (long[0] == lines.signatures([LONG.lower() * 3])[0]).all() and long.shape == (3, lines.BANDS * lines.ROWS)


def fives(line):
    """The contract's shingles, whatever size the module has."""
    line = " ".join(line.lower().split())
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def test_one_changed_letter_in_a_line_of_sixty_characters(spark):
    a = "the harbour master wrote 17 short letters about broken cranes"
    b = a.replace("short", "shert")
    assert 0.8 <= len(fives(a) & fives(b)) / len(fives(a) | fives(b)) < 0.9
    assert lines.similar_roots([a, b]).tolist() == [0, 0] and lines.shingles(a) == fives(a)
    docs = spark.createDataFrame([(1, a), (2, b), (3, B)], "doc_id int, text string")
    assert {r.doc_id for r in lines.dedup_lines(docs).collect()} == {1, 3}


@pytest.mark.parametrize("length", [13, 16, 25, 34, 47, 70, 150])
def test_similar_lines_meet_whatever_their_length(length):
    rng, a, b, wanted = random.Random(length), [], [], []
    for _ in range(1500):
        x = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length))
        end = (length - 4) // 9  # the most letters that may differ at the end at a similarity of 0.8
        y = x[:-end] + "".join(rng.choice("0123456789") for _ in range(end))
        similarity = len(fives(x) & fives(y)) / len(fives(x) | fives(y))
        assert similarity >= 0.8
        a.append(x)
        b.append(y)
        wanted.append(1 - (1 - similarity**5) ** 14)
    met = (lines.band_keys(lines.signatures(a)) == lines.band_keys(lines.signatures(b))).any(1)
    assert met.mean() >= np.mean(wanted) - 0.005


def test_signatures_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    texts = ["ab", "", "short line", "a" * 3000, LONG.lower() * 3, "the bird sat on the wall"]
    alone = np.concatenate([lines.signatures([t]) for t in texts])
    assert (lines.signatures(texts) == alone).all()
    monkeypatch.setattr(lines, "BLOCK", 64)
    assert (lines.signatures(texts) == alone).all()


def test_a_key_is_parted_into_lines_that_are_alike(monkeypatch):
    alike = [lines.plain(x) for x in variants(" ".join(f"{w}{i}" for i, w in enumerate(A.split() * 5)), 2)]
    texts = [LONG.lower()[:300], *alike, "z" * 9, alike[0]]
    words = lines.sketches(lines.signatures(texts)).view(np.int64)
    rows = np.array([(key, i if i < 4 else 1, *words[i]) for key in (7, 8, 9) for i in range(5)] + [(10, 0, *words[0]), (10, 3, *words[3]), (11, 2, *words[2])])

    def parts(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in rows[i : i + size].T], names=list("abcd")) for i in range(0, len(rows), size)]
        return {x for b in lines._meetings(lines._close(iter(batches))) for x in zip(*(c.to_pylist() for c in b.columns))}

    assert all(parts(size) == {(1, 2)} for size in (1, 2, 3, 7, 100))
    monkeypatch.setattr(lines, "KEY_ROWS", 3)  # a key of more rows than that ties them all
    assert all({(0, 1), (0, 2), (0, 3)} <= parts(size) for size in (1, 2, 4))


def test_meetings_over_batches():
    keys = np.repeat(np.arange(5), [1, 2, 3, 70_000, 4]).astype(np.int64)
    ids = np.arange(len(keys), dtype=np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 9000]), pa.array(ids[i : i + 9000])], names=["key", "id"]) for i in range(0, len(keys), 9000)]
    out = {x for b in lines._meetings(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns))}
    first = {int(k): int(ids[keys == k][0]) for k in range(5)}
    assert out == {(first[int(k)], int(i)) for k, i in zip(keys, ids) if first[int(k)] != i}


def test_keys_are_shuffled_in_buckets():
    rng = random.Random(3)
    texts = ["\n".join(" ".join(rng.choices(LONG.split(), k=6)) for _ in range(4000)) for _ in range(3)]
    packed = list(lines._band_rows(iter([pa.RecordBatch.from_arrays([pa.array([*texts, None, ""])], names=["text"])])))
    rows = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for b in packed for x in b.column(1).to_pylist()])
    found = list(dict.fromkeys(x for t in texts for x in t.split("\n")))
    assert len(rows) == len(found) * lines.BANDS > 10 * sum(map(len, packed))  # Spark moves a row for many keys
    ids = [xxhash.xxh64_intdigest(x.encode(), 42) for x in found]
    keys = lines.band_keys(lines.signatures([lines.plain(x) for x in found]))
    assert sorted(map(tuple, rows[:, :2].tolist())) == sorted((k, np.uint64(i).astype(np.int64)) for i, own in zip(ids, keys.tolist()) for k in own)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_buckets_give_the_keys_that_several_lines_have(size, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 3)
    rng = np.random.default_rng(size)
    rows = np.column_stack([rng.integers(-40, 40, 500) << 55, rng.integers(0, 30, 500), np.zeros((500, 2), np.int64)])
    rows = np.concatenate([rows, np.column_stack([np.full(900, 7 << 55), np.arange(900), np.zeros((900, 2), np.int64)])])  # one hot key
    table = pa.Table.from_batches([lines._dealt(x) for x in np.array_split(rng.permutation(rows), 3)]).sort_by("bucket")
    held = {}
    for k, i in rows[:, :2].tolist():
        held.setdefault(k, set()).add(i)

    def ties(batches):
        found = [(a, b) for b in lines._meetings(lines._close(batches)) for a, b in zip(*(c.to_pylist() for c in b.columns))]
        return roots(range(900), found)

    out = [r for b in lines._shared(iter(table.to_batches(size))) for r in zip(*(c.to_pylist() for c in b.columns[:2]))]
    assert len(out) == len(set(out)) and {x for x in out if len(held[x[0]]) > 1} == {(k, i) for k, ids in held.items() if len(ids) > 1 for i in ids}
    monkeypatch.setattr(lines, "BUCKET_ROWS", 50)
    monkeypatch.setattr(lines, "KEY_ROWS", 20)
    rows[:, 2] = np.arange(len(rows)) * 0x9E3779B97F4A7C1  # no sketches agree, so that only long keys tie
    table = pa.Table.from_batches([lines._dealt(x) for x in np.array_split(rng.permutation(rows), 3)]).sort_by("bucket")
    assert set(ties(lines._shared(iter(table.to_batches(size)))).values()) == {0}


def test_what_a_task_holds_of_a_bucket_stays_small():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 20, 3 << 18)  # one bucket: 24 MB of rows, and most of them copies
    rows = np.column_stack([keys % 5000, keys % 5000 * 7, np.zeros((len(keys), 2), np.int64)])
    batches = lines._dealt(rows)
    for some in (batches, batches.slice(3, 100), batches.slice(5, 0)):
        assert (lines._unpacked(some.column(1)) == np.frombuffer(b"".join(some.column(1).to_pylist()), np.int64).reshape(-1, 4)).all()
    tracemalloc.start()
    for _ in lines._shared(batches.slice(i, 500) for i in range(0, len(batches), 500)):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * rows.nbytes


def test_links_are_written_once(spark, monkeypatch):
    put = []
    for module in (lines, common):
        monkeypatch.setattr(module, "written", lambda df, label, old=module.written: (put.append(label), old(df, label))[1])
    a, b = A, A.replace("lazy", "lacy")
    got = spark.createDataFrame([(1, a, len(a)), (2, f"{b}\nnew", 0)], "doc_id long, text string, n_chars int").transform(lines.dedup_lines)
    assert sorted(map(tuple, got.collect())) == [(1, a, len(a)), (2, "new", 3)]
    assert not {"meetings", "links", "firsts", "kept"} & set(put) and "lost" in put


def test_short_lines_and_large_alphabets_are_compared_exactly():
    rng = random.Random(5)
    found = ["ab", "a", "abcd", "ab\0", "\0ab", "abcde", "Ab "] + ["".join(rng.choices("ab\U0001f600", k=rng.randrange(1, 12))) for _ in range(80)]
    wide = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300)) for _ in range(30)]
    for some in (found, found[:2], [wide[0], wide[0][:-9]], wide + [x[:-9] + "ab" for x in wide]):
        sets = [lines.shingles(x) for x in some]
        links = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
        assert lines.similar_roots(some).tolist() == list(roots(range(len(some)), links).values())


@pytest.mark.parametrize("seed", range(6))
def test_roots_match_all_pairs(seed):
    rng = random.Random(seed)
    found = [x for k in range(rng.randrange(1, 6)) for x in variants(" ".join(rng.sample(LONG.split(), 40)), rng.randrange(1, 30), seed + k)]
    rng.shuffle(found)
    sets = [lines.shingles(x) for x in found]
    links = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert lines.similar_roots(found).tolist() == list(roots(range(len(found)), links).values())


def test_bitmaps_let_all_similar_lines_through_and_few_others(monkeypatch):
    rng, found = random.Random(7), []
    for k, words in enumerate((2, 5, 12, 25, 40, 40, 60, 300)):
        base = [rng.choice(LONG.split()) + str(rng.randrange(100)) for _ in range(words)]
        for _ in range(60):  # a letter or two in up to a quarter of the words
            some = [w[:-1] + rng.choice("xyz") if rng.random() < rng.choice((0.02, 0.1, 0.25)) else w for w in base]
            found.append(" ".join(some))
    rng.shuffle(found)
    sets = [lines.shingles(x) for x in found]
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    links = [(i, j) for j in range(len(sets)) for i in range(j) if similar(sets[i], sets[j])]
    numbers = lines._numbered(found)
    near = lines._near(np.concatenate(numbers), np.array([len(x) for x in numbers]), 0.8)
    through = [set(near(i).tolist()) for i in range(len(found))]
    assert all(j in through[i] and i in through[j] for i, j in links)
    assert sum(map(len, through)) < 2 * (2 * len(links) + len(found)) < len(found) ** 2 / 8
    compared, old = 0, lines._overlaps

    def counted(*args):
        common = old(*args)

        def count(i, *some):
            nonlocal compared
            compared += len(some[0]) if some else len(found)
            return common(i, *some)

        return count

    monkeypatch.setattr(lines, "_overlaps", counted)
    assert lines.similar_roots(found).tolist() == list(roots(range(len(found)), links).values())
    assert compared < 10 * len(found)  # not every line with every other


def test_parts_hold_few_characters(spark, monkeypatch):
    monkeypatch.setattr(lines, "GROUP_CHARS", 4_000, raising=False)
    rows = [(g, 100 * g + i, str(i) * (100 if g else 5)) for g in (0, 1) for i in range(100)]
    parts = lines._blocks(spark.createDataFrame(rows, "group long, id long, line string"))
    held = {}
    for r in parts.collect():
        held.setdefault(r.part, {})[r.id] = len(r.line)
    assert held.pop(0) == {i: 5 * len(str(i)) for i in range(100)}
    assert max(sum(x.values()) for x in held.values()) <= 8_000
    together = {(a, b) for x in held.values() for a in x for b in x}
    assert together == {(100 + a, 100 + b) for a in range(100) for b in range(100)}


# ---- operator 8


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_any_four_errors_share_a_key():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64) * 2 + 1
    for spread in ([*range(64)], [*range(22)], [*range(22, 43)], [*range(43, 64)], [0, 1, 2, 30, 31, 50]):
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(spread, 4, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(bit)
        ra, ka = simhash.keys_of(a)
        rb, kb = simhash.keys_of(b)
        assert len({*zip(ra.tolist(), ka.tolist())} & {*zip(rb.tolist(), kb.tolist())}) and not set(range(400)) - {r for r, _ in {*zip(ra.tolist(), ka.tolist())} & {*zip(rb.tolist(), kb.tolist())}}


def check_groups(rows, got):
    prints = {d: brute_print(t) for d, t in rows}
    links = [(a, b) for a in prints for b in prints if b < a and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(prints, links)
    for d in prints:
        assert got[d].fingerprint == f"{prints[d]:016x}" and got[d].component_id == want[d]


@needs_tables
def test_groups_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_groups([(r.doc_id, r.text) for r in rows], by_id(simhash.op8_simhash(spark, SF)))


def test_groups_of_odd_documents(spark, tmp_path):
    base = " ".join(f"{w}{i}" for i, w in enumerate(A.split() * 12))
    rows = [(i, t, "en", "s") for i, t in enumerate([A, A.upper(), B, "", None, " \n", "a b", "A  B", "a b c d", *variants(base, 150)])]
    folder = stored(spark, tmp_path, documents=documents(spark, rows))
    check_groups([r[:2] for r in rows], by_id(simhash.op8_simhash(spark, folder)))
    empty = stored(spark, tmp_path / "empty", documents=documents(spark, []))
    assert simhash.op8_simhash(spark, empty).count() == 0


def test_runs_longer_than_a_task_compares(spark):
    rng = np.random.default_rng(5)
    prints = np.unique(np.array([np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, rng.integers(0, 4), replace=False).astype(np.uint64), initial=np.uint64(0)) for _ in range(250)], np.uint64)).view(np.int64)
    df = spark.createDataFrame([(int(x),) for x in prints], "fp long")
    want = roots(prints.tolist(), [(int(a), int(b)) for a in prints for b in prints if b < a and (int(a) ^ int(b)).bit_count() <= 4])
    for run in (4, 1024):
        got = dict(simhash.links(df, run=run).collect())
        assert got == {n: r for n, r in want.items() if n != r}


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 3, 4, 5, 9, 10, 11, 12, 13] or sorted(r.doc_id for r in rows if r.doc_id) == [1, 4, 5, 9, 10, 11, 12, 13]
    assert sum(r.doc_id is None for r in rows) == 0 and simhash.keep_one(docs.limit(0)).count() == 0
