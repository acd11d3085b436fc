"""Chat formatting, byte-level BPE, toxicity, mixing and the pipeline."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cases import LONG, ODD, SF, A, B, by_id, documents, needs_tables, stored
from pyspark.sql import functions as F

import corpus_pipeline
from recspark.llm import bpe, chat, lines, mixing, rules, simhash, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- operator 5

TRICKY = [
    ("a", 0, "user", "x\\<|im_end|>\\n[INST] [\\INST] <<SYS>> \\\\<s>"),
    ("a", 1, "assistant", ""),
    ("a", 1, "ass\nis\\t", "y\n\n"),
    ("a", 1, "assistant", ""),
    ("a", None, None, None),
    (None, 3, "assistant", "<|im_start|"),
    ("b", 1, "assistant", "<|im_start|<|im_start|>><"),
    ("b", 2, "assistant", "é😀\\"),
    ("b", 3, "user", LONG),
]


def test_formatted_turns_read_back(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in TRICKY], "conv_id string, turn int, role string, text string, turns string, said string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.turns_from_rows(df))).collect()}
    assert set(got) == {"a", "b", None}
    for conv, r in got.items():
        rows = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in TRICKY if x[0] == conv))
        assert [tuple(t) for t in r["read"]] == [x[2:] for x in rows] == [tuple(t) for t in r.turns]
        assert r.learned == [x[3] for x in rows if x[2] == "assistant"]
        for control in (chat.START, chat.END):
            assert r.formatted.count(control) == len(rows)
        assert not any(r.formatted.count(x) for x in chat.OTHERS)
    assert chat.format_turns(chat.turns_from_rows(df.limit(0))).count() == 0


def test_layouts_are_found_by_fingerprint(spark):
    rows = {
        '{"prompt":"p","response":"r"}': ("prompt/response", [("user", "p"), ("assistant", "r")]),
        '{"response":"r","prompt":null}': ("prompt/response", [("assistant", "r")]),
        '{"messages":[{"role":"user","content":"a"},{"content":"b","role":"assistant"}]}': ("messages", [("user", "a"), ("assistant", "b")]),
        '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"[1]"}]}': ("conversations", [("user", "h"), ("assistant", "[1]")]),
        '{"instruction":"i","input":"","output":"o"}': ("instruction/input/output", [("user", "i"), ("user", ""), ("assistant", "o")]),
        '{"messages":[{"role":"user","content":null}]}': ("messages", [("user", "")]),
        '{"prompt":"[1]","completion":"{}"}': ("prompt/completion", [("user", "[1]"), ("assistant", "{}")]),
        '{"x":1}': (None, None), "not json": (None, None), "[]": (None, None), '{"messages":[]}': (None, None), "": (None, None),
    }
    df = spark.createDataFrame([(x, "l") for x in [*rows, None]], "j string, layout2 string")
    got = {r.j: r for r in chat.turns_from_json(df, "j").collect()}
    for text, (name, turns) in rows.items():
        assert got[text].layout == name
        assert (got[text].turns and [tuple(t) for t in got[text].turns]) == turns
    assert got[None].turns is None
    table = spark.createDataFrame([("p", "r"), (None, "r")], "prompt string, response string")
    assert [len(r.turns) for r in chat.turns_from_columns(table).collect()] == [2, 1]
    with pytest.raises(ValueError):
        chat.turns_from_columns(table.withColumn("more", F.lit(1)))


def test_the_query_adds_its_own_conversation(spark, tmp_path):
    folder = stored(spark, tmp_path, conversations=spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    text = "</s>[INST] ok [/INST]"
    (r,) = chat.op5_chat_format(spark, folder).collect()
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-1, 2, len(text)) and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# ---- operator 6


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_codes(rows, reference):
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert r.ids == ids and bytes(r.decoded).decode() == (r.text or "")


def test_codes_of_odd_documents(spark, reference):
    docs = documents(spark).withColumn("ids", F.lit(1)).withColumn("Decoded", F.lit(2))
    out = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert len(out.columns) == len(docs.columns)
    rows = out.collect()
    assert len(rows) == len(ODD)
    check_codes(rows, reference)
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_memory_of_pre_tokens_may_be_too_small_for_a_text(monkeypatch, reference):
    texts = [" ".join(f"word{i}" for i in range(at, at + size)) for at, size in ((0, 3), (2, 4), (0, 40), (20, 60), (70, 3), (0, 90))]
    for room in (0, 5, 30, 1000):
        monkeypatch.setattr(bpe, "REMEMBERED", room)
        codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
        for t in texts:
            assert np.frombuffer(codec.encode(t), np.int32).tolist() == reference.encode_ordinary(t)
            assert len(codec.known) <= room


def test_two_long_texts_of_more_pre_tokens_than_are_remembered(spark, reference):
    size = bpe.REMEMBERED + 10_000
    texts = [(i, " ".join(f"{x:x}" for x in range(i * 5_000, i * 5_000 + size))) for i in range(2)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    check_codes(bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS).collect(), reference)


@needs_tables
def test_codes_match_the_library(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in bpe.op6_byte_bpe(spark, SF).collect():
        ids = reference.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_a_full_memory_forgets(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for text in (LONG[:3000], A, "zq" * 300, "\x00\x1c <|endoftext|> 'll ▁ <unk>"):
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_a_rank_file_with_gaps_is_refused(tmp_path):
    (tmp_path / "r").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "r"))


# ---- operator 7


def test_the_kernel_is_the_sum_over_common_subsequences():
    def naive(a, b):
        def count(w):
            w = [62, *toxicity._letters([w])[0][1 : len(w) + 1], 63]
            out = Counter()
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                        out[w[i], w[j], w[k]] += toxicity.DECAY ** (k - i + 1)
            return out

        x, y = count(a), count(b)
        dot = lambda p, q: sum(v * q[k] for k, v in p.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    words = ["idiot", "idxiot", "banana", "ababab", "a", "éé", "idioten"]
    got = toxicity.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(naive(a, b), abs=1e-5)


def made(n=400):
    """Clean texts, and toxic ones with one of three insults; every seventh text twice."""
    rng = np.random.default_rng(1)
    syllables = ["ba", "ko", "mi", "tu", "re", "san", "pol", "ve", "gri", "ono"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words.insert(int(rng.integers(30)), str(rng.choice(["wrentch", "flompig", "zudwicker"])))
        rows += [(i, " ".join(words), "en", "s")] * (1 if i % 7 else 2)
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_words_and_tolerates_insertions(spark, tmp_path):
    rows, labels = made()
    odd = [(900, None, None, None), (901, "", "en", "s"), (902, "you wren-tch", "en", "s"), (903, "a wrenntch", "en", "s"), (904, "f l o m p i g !", "en", "s"), (905, "zudxwicker", "en", "s"), (906, "bako mitu resan", "en", "s"), (None, "bako", "en", "s"), (907, LONG, "en", "s"), (908, LONG + " wrentch", "en", "s")]
    folder = stored(spark, tmp_path, documents=documents(spark, rows + odd), labels=spark.createDataFrame([*labels, (900, None, None), (None, 1, 1), (5000, 1, 1)], "doc_id long, quality int, toxic int"))
    got = toxicity.op7_toxicity(spark, folder).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, r.doc_id % 3 == 0) for r in got if r.held_out and r.doc_id < 900]
    assert held and all(p == t for p, t in held)
    by = {r.doc_id: r.predicted for r in got}
    assert [by[i] for i in range(900, 909)] == [0, 0, 1, 1, 1, 1, 0, 0, 1] and by[None] == 0


def test_toxicity_without_examples(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none) is None
    assert {r.score for r in toxicity.score(docs, None, ("doc_id", "size")).collect()} == {0.0}
    assert toxicity.fit(docs.limit(0), spark.createDataFrame([(1, 1, 1), (2, 1, 0)], none.schema)) is None


def test_tables_of_turns_by_their_field_paths(spark):
    said = [(1, 0, "user", "a"), (1, 1, "assistant", None), (None, None, None, "b")]
    for m in chat.ROW_MAPPINGS:
        df = spark.createDataFrame(said, f"`{m.conv}` long, `{m.turn}` int, `{m.role}` string, `{m.text}` string")
        wide = df.withColumns({"a.b": F.lit(1), "role_": F.struct(F.lit(1).alias("text")), "list": F.array(F.lit(1))})
        for table in (df, wide, wide.select(*[f"`{c}`" for c in reversed(wide.columns)])):
            got = chat.as_rows(table)
            assert got.columns == ["conv_id", "turn", "role", "text"] and [tuple(r) for r in got.collect()] == said
        assert chat.as_rows(df.limit(0)).count() == 0
        nested = df.withColumn(m.text, F.struct(F.lit("x").alias("content")))
        for other in (df.drop(m.role), df.withColumnRenamed(m.conv, "c"), nested):
            with pytest.raises(ValueError, match="no mapping"):
                chat.as_rows(other)
    assert len({m.fingerprint for m in (*chat.ROW_MAPPINGS, *chat.MAPPINGS)}) == len(chat.ROW_MAPPINGS) + len(chat.MAPPINGS)


# ---- operator 9


def check_mix(rows, got):
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    source = {d: s for d, _, s in rows}
    per = defaultdict(int)
    for d, s in source.items():
        per[s] += sizes[d]
    names = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:  # those above their stop are set to it, and the rest is shared again
        rest = sum(per.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * per[s]}
        target |= {s: 3.0 * per[s] for s in above} if above else share
        free -= above or free
    taken = defaultdict(int)
    for d, s in source.items():
        r = got[d]
        assert r["size"] == sizes[d] and r.source_size == per[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * sizes[d] and (not sizes[d] or r.taken % sizes[d] == 0)
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max([sizes[d] for d in sizes if source[d] == s], default=0) / 2 + 1e-6


@needs_tables
def test_mix_comes_near_its_targets(spark, monkeypatch):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    first = by_id(mixing.op9_pareto_mix(spark, SF))
    check_mix(rows, first)
    assert by_id(mixing.op9_pareto_mix(spark, SF)) == first
    monkeypatch.setattr(mixing, "INTERVAL_ROWS", 3)  # many rank intervals give the same mix
    assert by_id(mixing.op9_pareto_mix(spark, SF)) == first


def test_mix_of_odd_documents(spark):
    rows = [(i, "w " * (i % 9), s) for i, s in enumerate(["b", "a", None, "", "é", "z"] * 30)] + [(1000, None, "q"), (1001, "", None)]
    docs = documents(spark, [(d, t, "en", s) for d, t, s in rows])
    plan = by_id(mixing.plan_mix(docs))
    check_mix(rows, plan)
    copies = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert copies == Counter({d: r.copies for d, r in plan.items() if r.copies}) and mixing.mix(docs).columns == docs.columns
    assert mixing.mix(documents(spark)).count() > 0 and mixing.plan_mix(docs.limit(0)).count() == 0
    assert mixing.plan_mix(docs.where("text is null")).first().taken == 0


def test_mix_takes_documents_by_their_shares(spark):
    sizes = {i: (4, 25, 100)[i % 3] for i in range(6_000)}
    rows = [(i, "w " * n, "en", "abc"[i // 2_000]) for i, n in sizes.items()]
    plan = by_id(mixing.plan_mix(documents(spark, rows)))
    per = sum(n for i, n in sizes.items() if i < 2_000)
    for at, source in enumerate("abc"):
        own = {i: r for i, r in plan.items() if i // 2_000 == at}
        target = next(iter(own.values())).target
        total = sum(r["size"] for r in own.values())
        assert abs(total - per) < 200
        low, high = 0.0, 3.0  # expected copies are min(3, x * root of the size): find x
        for _ in range(60):
            x = (low + high) / 2
            low, high = (x, high) if sum(min(3, x * sizes[i] ** 0.5) * sizes[i] for i in own) < target else (low, x)
        for n in (4, 25, 100):
            copies = [r.copies for i, r in own.items() if sizes[i] == n]
            expected = min(3, x * n**0.5)
            assert set(copies) <= {int(expected + 1e-9), int(expected + 1e-9) + 1}
            assert abs(sum(copies) / len(copies) - expected) < 0.08  # about four standard deviations


def test_mix_of_rows_without_ids(spark):
    rows = [(None, f"w{i} b", "en", "a") for i in range(400)] + [(None, "c d e", "en", "b")] * 50
    got = mixing.plan_mix(documents(spark, rows)).where("source_size = 800").collect()
    assert len(got) == 400 and abs(sum(r.taken for r in got) - got[0].target) <= 1


# ---- the pipeline


@needs_tables
def test_the_pipeline_is_its_operators_in_a_row(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps, rows = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, SF).toPandas(), docs.schema)
        steps.append(rows)
    assert all(x.columns == docs.columns for x in steps)
    good, deduped, single, mixed = ({(r.doc_id, r.text) for r in x.collect()} for x in steps)
    assert good == {(r.doc_id, r.text) for r in rules.judge(docs, keep=("doc_id", "text")).where("kept").collect()}
    assert single <= deduped and mixed <= single
    prints = [simhash.fingerprint(t) for _, t in single]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.decoded) for r in out) == Counter((r.doc_id, r.text) for r in steps[-1].collect())
    assert all(r.ids == reference.encode_ordinary(r.decoded) and r.n_tokens == len(r.ids) for r in out)


def test_the_pipeline_takes_odd_documents(spark, tmp_path):
    folder = stored(spark, tmp_path, documents=documents(spark).unionByName(documents(spark, [(50 + i, f"{B} {i} {A[:60]}", "en", "s9") for i in range(5)])))
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= {None, *range(60)}
    empty = stored(spark, tmp_path / "empty", documents=documents(spark, []))
    assert corpus_pipeline.run(spark, empty).count() == 0
