"""Byte-level BPE through a sentencepiece model made from a rank file (operator 6)."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2 as pb

#: Distinct pre-tokens whose ids a worker remembers at most, beside those of the text at hand.
REMEMBERED = 200_000
#: Texts are handed on in groups of about this many ids.
GROUP_IDS = 1 << 20


def byte_letters() -> list[str]:
    """One printable letter for each byte: bytes that print as Latin-1 stand for themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (lines of base64 and rank) in order of rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"ranks in {path} have gaps or repeat")
    return [tokens[i] for i in range(len(tokens))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model with the same merges.

    Piece ``i + 1`` is token ``i`` with its bytes written as letters, scored ``-i``: the pair that makes the piece of
    the best score is merged first, leftmost first, just as the pair of the lowest rank.  Piece 0 is the unknown piece
    that the format asks for.  Text goes in as it is: identity normalisation, no dummy prefix, no white space rules.
    """
    letters = byte_letters()
    model = pb.ModelProto()
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    for rank, token in enumerate(tokens):
        model.pieces.add(piece="".join(letters[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    spec = model.trainer_spec
    spec.model_type = pb.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = 0, -1, -1, -1
    spec.byte_fallback = False
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.precompiled_charsmap = b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes in one worker."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.whole = {t: np.int32(i).tobytes() for i, t in enumerate(self.tokens)}
        self.letters = byte_letters()
        self.table = {b: c for b, c in enumerate(self.letters)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _coded(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of pre-tokens; one that is a token as a whole is that token."""
        out, rest = {}, []
        for p in parts:
            ids = self.whole.get(p.encode())
            if ids is not None:
                out[p] = ids
            else:
                rest.append(p)
        coded = self.model.encode([p.encode().decode("latin-1").translate(self.table) for p in rest], num_threads=1)
        out.update((p, (np.asarray(ids, np.int32) - 1).tobytes()) for p, ids in zip(rest, coded))
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers.

        New pre-tokens are remembered while there is room.  Where there is none, the text is coded with what is known and its own
        new ones, and the memory starts again with those, unless they alone are too many.
        """
        parts = self.split(text)
        distinct = set(parts)
        missing = distinct.difference(self.known)
        ids = self.known
        if missing:
            new = self._coded(list(missing))
            if len(self.known) + len(new) <= REMEMBERED:
                self.known.update(new)
            else:
                ids = new | {p: self.known[p] for p in distinct.difference(missing)}
                self.known = new if len(new) <= REMEMBERED else {}
        return b"".join(map(ids.__getitem__, parts))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(path: str, pattern: str) -> Codec:
    """A worker reads the rank file once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the column ``ids``, array<int>: the token ids of the whole text, without special tokens.

    ``pattern`` cuts the text into pre-tokens, each of which is merged separately.  A null or empty text has no ids, a very long one
    is coded whole, and repeated rows stay, each with its ids.  A column that is already called ``ids`` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            at, parts, total = 0, [], 0
            for i, t in enumerate(batch.column(position)):
                parts.append(codec.encode(t.as_py() or ""))
                total += len(parts[-1]) // 4
                if total >= GROUP_IDS or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*batch.slice(at, len(parts)).columns, _lists(parts)], names=names)
                    at, parts, total = i + 1, [], 0

    df = _without(df, ids)
    position = df.columns.index(text)
    names = [*df.columns, ids]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]))


def decode(df: DataFrame, path: str, pattern: str = "", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the column ``out``, binary: the bytes that the ids stand for.  Null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            column = batch.column(position)
            values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [codec.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=names)

    df = _without(df, out)
    position = df.columns.index(ids)
    names = [*df.columns, out]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType(), False)]))


def _without(df: DataFrame, name: str) -> DataFrame:
    """``df`` without a column of that name, in any case: as with ``withColumn``, the new one takes its place."""
    return df.drop(*[c for c in df.columns if c.lower() == name.lower()])


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, path, pattern).drop("text")
    return decode(coded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
