"""Record schemas: typed, fixed-width fields expressed as a Spark ``StructType``.

A record is a flat row whose first field is always ``TimeStamp`` (epoch seconds,
double).  What Spark's own types cannot say -- the source type, the fixed element
count of an array field, the named bits of an integer word -- is kept in the field
metadata, so a schema travels with the DataFrame and through Parquet.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
from pyspark.sql import types as T

TIME_FIELD = "TimeStamp"

# Source type -> little-endian NumPy code.
NUMPY_CODES = {
    "Bool": "?",
    "Char": "S1",
    "Int8": "<i1",
    "UInt8": "<u1",
    "Int16": "<i2",
    "UInt16": "<u2",
    "Int32": "<i4",
    "UInt32": "<u4",
    "Int64": "<i8",
    "UInt64": "<u8",
    "Float": "<f4",
    "Double": "<f8",
}

# Spark has no unsigned integers, so each one widens to the next type that holds it.
SPARK_TYPES = {
    "Bool": T.BooleanType(),
    "Char": T.StringType(),
    "Int8": T.ByteType(),
    "UInt8": T.ShortType(),
    "Int16": T.ShortType(),
    "UInt16": T.IntegerType(),
    "Int32": T.IntegerType(),
    "UInt32": T.LongType(),
    "Int64": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "Float": T.FloatType(),
    "Double": T.DoubleType(),
}

INTEGER_TYPES = frozenset(n for n in NUMPY_CODES if "Int" in n)
NUMERIC_TYPES = INTEGER_TYPES | {"Float", "Double"}

# What a plain Spark column is taken for when it carries no metadata.
_DEFAULT_SOURCE = {
    "boolean": "Bool",
    "tinyint": "Int8",
    "smallint": "Int16",
    "int": "Int32",
    "bigint": "Int64",
    "decimal(20,0)": "UInt64",
    "float": "Float",
    "double": "Double",
}


def type_size(src_type: str) -> int:
    """Bytes taken by one element of a source type."""
    return np.dtype(NUMPY_CODES[check_type(src_type)]).itemsize


def check_type(src_type: str) -> str:
    if src_type not in NUMPY_CODES:
        raise ValueError(f"unsupported field type {src_type!r}; use one of {', '.join(NUMPY_CODES)}")
    return src_type


def bit_positions(bit_defs: Iterable) -> dict[str, int]:
    """Bit names to positions, from the least significant bit up.

    A purely numeric entry leaves that many bits unnamed.
    """
    positions: dict[str, int] = {}
    at = 0
    for entry in map(str, bit_defs):
        if entry.isdigit():
            at += int(entry)
            continue
        if entry in positions:
            raise ValueError(f"bit {entry!r} is named twice")
        positions[entry] = at
        at += 1
    return positions


def field(name: str, src_type: str, count: int = 1, bits: Mapping[str, int] | None = None) -> T.StructField:
    """One record field as a ``StructField`` carrying its source type."""
    check_type(src_type)
    if not name:
        raise ValueError("a field needs a name")
    if count < 1:
        raise ValueError(f"field {name!r} needs a positive element count, not {count}")
    bits = dict(bits or {})
    if bits and src_type not in INTEGER_TYPES:
        raise ValueError(f"field {name!r}: only integer fields can have named bits")
    if bits and max(bits.values()) >= 8 * type_size(src_type):
        raise ValueError(f"field {name!r}: more bits than {src_type} holds")

    spark_type = SPARK_TYPES[src_type]
    if src_type == "UInt64" and bits:
        spark_type = T.LongType()  # bit functions need an integral type; two's complement
    if count > 1 and src_type != "Char":
        spark_type = T.ArrayType(spark_type, containsNull=False)
    meta = {"src_type": src_type, "count": count, "bits": bits}
    return T.StructField(name, spark_type, nullable=False, metadata=meta)


def _from_spec(spec: tuple) -> T.StructField:
    """``(name, type, shape)``: a field of ``shape`` elements (1 if left out), or a word whose bits ``shape`` names."""
    if not 2 <= len(spec) <= 3:
        raise ValueError(f"a field is given by name, type and shape, not by {spec!r}")
    name, src_type, shape = (*spec, 1)[:3]
    if isinstance(shape, (list, tuple)):
        return field(name, src_type, bits=bit_positions(shape))
    return field(name, src_type, int(shape))


def record_schema(fields: Iterable, align: bool = False) -> T.StructType:
    """Field specs to a schema with ``TimeStamp`` first.

    A spec is ``(name, type)``, ``(name, type, count)``, ``(name, type, [bits])`` or a
    ready ``StructField``.  ``align`` orders the fields by decreasing element size
    (stable), which puts each of them on its natural boundary in a binary record.
    """
    out = [spec if isinstance(spec, T.StructField) else _from_spec(spec) for spec in fields]
    if align:
        out.sort(key=lambda f: -type_size(source_type(f)))
    schema = T.StructType([field(TIME_FIELD, "Double"), *out])
    if len(set(schema.names)) != len(schema.names):
        raise ValueError(f"field names must be unique: {schema.names}")
    bit_names = [b for f in schema for b in named_bits(f)]
    if len(set(bit_names)) != len(bit_names):
        raise ValueError(f"bit names must be unique in a record: {bit_names}")
    if set(bit_names) & set(schema.names):
        raise ValueError(f"a bit may not be named like a field: {sorted(set(bit_names) & set(schema.names))}")
    return schema


def source_type(f: T.StructField) -> str:
    """The source type of a column: its metadata, or the closest type for a plain column."""
    if "src_type" in (f.metadata or {}):
        return f.metadata["src_type"]
    element = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
    try:
        return _DEFAULT_SOURCE[element.simpleString()]
    except KeyError:
        raise ValueError(f"column {f.name!r} of type {f.dataType.simpleString()} is not a record field") from None


def is_record_field(f: T.StructField) -> bool:
    try:
        source_type(f)
    except ValueError:
        return False
    return True


def is_numeric(f: T.StructField) -> bool:
    return is_record_field(f) and source_type(f) in NUMERIC_TYPES


def is_array(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.ArrayType)


def element_count(f: T.StructField) -> int:
    """Fixed element count of a field; arrays must declare theirs."""
    count = (f.metadata or {}).get("count")
    if count is None:
        if is_array(f):
            raise ValueError(f"array field {f.name!r} does not declare its element count")
        return 1
    return int(count)


def named_bits(f: T.StructField) -> dict[str, int]:
    bits = (f.metadata or {}).get("bits") or {}
    return {k: int(v) for k, v in sorted(bits.items(), key=lambda kv: kv[1])}


def find_bit(schema: T.StructType, bit_name: str) -> tuple[T.StructField, int]:
    """The word holding a named bit, and the bit's position in it."""
    for f in schema:
        if bit_name in named_bits(f):
            return f, named_bits(f)[bit_name]
    raise KeyError(f"no field has a bit named {bit_name!r}")


def describe_fields(schema: T.StructType) -> list[tuple[int, str, str, int, dict[str, int]]]:
    """``(pos, field, src_type, count, bits)`` of each field."""
    return [(i, f.name, source_type(f), element_count(f), named_bits(f)) for i, f in enumerate(schema)]


def record_dtype(schema: T.StructType, align: bool = False) -> np.dtype:
    """Binary layout of a record: packed in field order, or padded at the end if aligned."""
    names, formats, offsets, at, widest = [], [], [], 0, 1
    for f in schema:
        code, count = NUMPY_CODES[source_type(f)], element_count(f)
        if source_type(f) == "Char":
            item = np.dtype(f"S{count}")
        else:
            item = np.dtype((code, (count,))) if count > 1 else np.dtype(code)
        names.append(f.name)
        formats.append(item)
        offsets.append(at)
        at += item.itemsize
        widest = max(widest, type_size(source_type(f)))
    if align:
        at += -at % widest
    return np.dtype({"names": names, "formats": formats, "offsets": offsets, "itemsize": at})
