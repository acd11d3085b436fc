"""Binary record files: the section frame, and rows to and from fixed-width bytes.

A file is a run of sections.  Each starts with a 24-byte little-endian frame (marker u16,
type u16, body length u64, alias char[12]).  A Header section's body is the record schema as
JSON; a Data section's body is packed records of the last header's schema.  A file may end with an
Index section: the time bounds of each block of records, and its own place, by which it is found from the
end of the file.  This layout is this package's own and reads no other tool's files.

These helpers run inside tasks, one byte range or Arrow batch at a time.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from ..schema import NUMPY_CODES, TIME_FIELD, element_count, is_array, record_dtype, source_type

MARKER = 0x5243
HEADER, DATA, INDEX = 1, 2, 3
TYPE_NAMES = {HEADER: "Header", DATA: "Data", INDEX: "Index"}
FRAME = "<HHQ12s"
FRAME_BYTES = struct.calcsize(FRAME)
MAX_ALIAS_BYTES = 12
#: One block in an index: its section, its records ``[at, at + n)`` in it, and their least and greatest time.
BLOCK = np.dtype([("section", "<i8"), ("at", "<i8"), ("n", "<i8"), ("low", "<f8"), ("high", "<f8")])
#: An index ends with the byte at which its section starts, and these letters.
TAIL = "<Q8s"
TAIL_BYTES = struct.calcsize(TAIL)
TAIL_MARK = b"recindex"


@dataclass(frozen=True)
class Section:
    """One section as found in a file; ``layout`` is that of the header before it."""

    idx: int
    kind: int
    alias: str
    start: int  # of the body
    length: int
    schema: T.StructType | None
    align: bool
    dtype: np.dtype | None
    first_record: int  # records in the file's earlier data sections

    @property
    def records(self) -> int:
        return self.length // self.dtype.itemsize if self.kind == DATA and self.dtype is not None else 0


def frame(kind: int, alias: str, length: int) -> bytes:
    raw = alias.encode()
    if len(raw) > MAX_ALIAS_BYTES:
        raise ValueError(f"alias {alias!r} is longer than {MAX_ALIAS_BYTES} bytes")
    return struct.pack(FRAME, MARKER, kind, length, raw)


def header_section(schema: T.StructType, align: bool, alias: str) -> bytes:
    body = json.dumps({"schema": schema.jsonValue(), "align": align}).encode()
    return frame(HEADER, alias, len(body)) + body


def walk(f, size: int, name: str, growing: bool = False) -> Iterator[Section]:
    """Sections of the first ``size`` bytes of an open file, in order.  Only frames and headers are read.

    A section that is cut off is an error, or, in a file that is still ``growing``, the last one: of a data section the whole
    records that are there, of any other nothing.
    """
    at, idx, seen = 0, 0, 0
    schema = dtype = None
    align = False
    while at < size:
        f.seek(at)
        raw = f.read(FRAME_BYTES)
        if len(raw) < FRAME_BYTES or growing and at + FRAME_BYTES > size:
            if growing:
                return
            raise ValueError(f"{name}: cut off in the frame at byte {at}")
        marker, kind, length, alias = struct.unpack(FRAME, raw)
        if marker != MARKER:
            raise ValueError(f"{name}: no section at byte {at}")
        start = at + FRAME_BYTES
        if start + length > size and growing:
            if kind != DATA or dtype is None:
                return
            length = (size - start) // dtype.itemsize * dtype.itemsize
            yield Section(idx, kind, alias.rstrip(b"\0").decode(), start, length, schema, align, dtype, seen)
            return
        if start + length > size:
            raise ValueError(f"{name}: the section at byte {at} is cut off")
        if kind == HEADER:
            head = json.loads(f.read(length))
            schema, align = T.StructType.fromJson(head["schema"]), head["align"]
            dtype = record_dtype(schema, align)
        if kind == DATA and dtype is None:
            raise ValueError(f"{name}: data at byte {at} comes before any header")
        s = Section(idx, kind, alias.rstrip(b"\0").decode(), start, length, schema, align, dtype, seen)
        if kind == DATA and length % dtype.itemsize:
            raise ValueError(f"{name}: the data section at byte {at} does not hold whole records")
        yield s
        seen += s.records
        at, idx = start + length, idx + 1


def time_bounds(block: bytes, dtype: np.dtype) -> tuple[float, float]:
    """Least and greatest time of a block of records; NaN counts as greater than any time, as in Spark."""
    times = np.frombuffer(block, dtype)[TIME_FIELD]
    if times.dtype != np.dtype("<f8"):
        return -np.inf, np.nan  # no bounds
    numbers = times[~np.isnan(times)]
    low = numbers.min() if len(numbers) else np.nan
    return float(low), float(numbers.max()) if len(numbers) == len(times) else np.nan


def index_section(blocks: list[tuple], alias: str, at: int) -> bytes:
    """The index of a file whose other sections end at byte ``at``."""
    body = np.array(blocks, BLOCK).tobytes() + struct.pack(TAIL, at, TAIL_MARK)
    return frame(INDEX, alias, len(body)) + body


def read_index(f, size: int) -> np.ndarray | None:
    """The blocks of an open file; None if it has no index of the whole file, such as files put one after the other."""
    if size < FRAME_BYTES + TAIL_BYTES:
        return None
    f.seek(size - TAIL_BYTES)
    at, mark = struct.unpack(TAIL, f.read(TAIL_BYTES))
    if mark != TAIL_MARK or at > size - FRAME_BYTES - TAIL_BYTES:
        return None
    f.seek(at)
    marker, kind, length, _ = struct.unpack(FRAME, f.read(FRAME_BYTES))
    if marker != MARKER or kind != INDEX or at + FRAME_BYTES + length != size or (length - TAIL_BYTES) % BLOCK.itemsize:
        return None
    return np.frombuffer(f.read(length - TAIL_BYTES), BLOCK)


def spark_array(column: np.ndarray, f: T.StructField) -> pa.Array:
    """One field of a block of records as an Arrow array of the field's Spark type."""
    if source_type(f) == "Char":
        chars = np.array(column).view("u1").reshape(len(column), -1)
        chars[np.logical_or.accumulate(chars == 0, axis=1)] = 0  # the text ends at the first NUL
        text = np.char.decode(chars.view(column.dtype).reshape(-1), "latin-1")
        return pa.array(text, pa.string())
    base = f.dataType.elementType if is_array(f) else f.dataType
    flat = np.ascontiguousarray(column).reshape(-1)
    if isinstance(base, T.DecimalType):
        values = pa.array(flat).cast(pa.decimal128(20, 0))
    elif source_type(f) == "UInt64":
        values = pa.array(flat.view("<i8"))
    else:
        wide = {"tinyint": "i1", "smallint": "i2", "int": "i4", "bigint": "i8", "float": "f4", "double": "f8", "boolean": "?"}
        values = pa.array(flat.astype(wide[base.simpleString()], copy=False))
    if not is_array(f):
        return values
    n = element_count(f)
    offsets = pa.array(np.arange(0, len(flat) + 1, n, dtype="i4"))
    item = pa.field("element", values.type, nullable=False)
    return pa.ListArray.from_arrays(offsets, values, type=pa.list_(item))


def decode(block: bytes, section: Section, wanted: T.StructType) -> list[pa.Array]:
    """The wanted fields of a block of whole records."""
    rows = np.frombuffer(block, section.dtype)
    return [spark_array(rows[f.name], f) for f in wanted]


def _source_values(values: pa.Array, f: T.StructField) -> np.ndarray:
    """Element values in the field's source type; out of range is an error, never a wrap."""
    src = source_type(f)
    if src == "UInt64":
        if pa.types.is_decimal(values.type):
            return values.cast(pa.uint64()).to_numpy(zero_copy_only=False)
        return values.to_numpy(zero_copy_only=False).view("<u8")
    got = values.to_numpy(zero_copy_only=False)
    code = np.dtype(NUMPY_CODES[src])
    if code.kind == "u" and len(got):
        info = np.iinfo(code)
        if got.min() < info.min or got.max() > info.max:
            raise ValueError(f"field {f.name!r}: {got.min()}..{got.max()} does not fit {src}")
    return got.astype(code, copy=False)


def _chars(column: pa.Array, n: int, name: str) -> np.ndarray:
    """Text as ``n`` Latin-1 bytes each, filled up with NUL."""
    letters = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), "<u4")
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    if len(letters) and letters.max() > 0xFF:
        raise ValueError(f"field {name!r}: text outside Latin-1")
    if (letters == 0).any():
        raise ValueError(f"field {name!r}: text with a NUL, where a stored text ends")
    if len(lengths) and lengths.max() > n:
        raise ValueError(f"field {name!r}: text longer than {n} characters")
    out = np.zeros((len(lengths), n), "u1")
    out[np.arange(n)[None, :] < lengths[:, None]] = letters
    return out.view(f"S{n}").reshape(-1)


def encode(batch: pa.RecordBatch, schema: T.StructType, dtype: np.dtype) -> bytes:
    """An Arrow batch as packed records."""
    rows = np.zeros(batch.num_rows, dtype)
    for f, column in zip(schema, batch.columns):
        if column.null_count:
            raise ValueError(f"field {f.name!r}: records hold no nulls")
        n = element_count(f)
        if source_type(f) == "Char":
            rows[f.name] = _chars(column, n, f.name)
        elif is_array(f):
            flat = column.flatten()
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            if flat.null_count or (lengths != n).any():
                raise ValueError(f"field {f.name!r}: every array must hold {n} elements and no nulls")
            rows[f.name] = _source_values(flat, f).reshape(-1, n) if n > 1 else _source_values(flat, f)
        else:
            rows[f.name] = _source_values(column, f)
    return rows.tobytes()


def check_writable(schema: T.StructType) -> None:
    if not schema.names or schema.names[0] != TIME_FIELD:
        raise ValueError(f"the first column of a recording must be {TIME_FIELD}")
    record_dtype(schema)
