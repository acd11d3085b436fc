"""Projections on record fields: elements of arrays, named bits, channels.

Everything here is a column expression or a single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.ranges import col
from ..schema import (
    SPARK_TYPES,
    TIME_FIELD,
    check_type,
    element_count,
    find_bit,
    is_array,
    is_numeric,
    is_record_field,
    named_bits,
    source_type,
    type_size,
)


def select_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named fields."""
    return df.select(*[col(n) for n in names])


def in_range(df: DataFrame, lo, hi, on: str = TIME_FIELD) -> DataFrame:
    """Records whose position or time lies in the closed range."""
    return df.where(col(on).between(lo, hi))


def element(df: DataFrame, field: str, index: int = 0) -> Column:
    """A scalar field, or one element of an array field (0-based)."""
    f = df.schema[field]
    if is_array(f):
        return F.get(col(field), F.lit(index))
    if index:
        raise IndexError(f"field {field!r} has one element, not {index + 1}")
    return col(field)


def value(df: DataFrame, field: str, index: int = 0, as_type: str = "Double") -> Column:
    """A field or element as a number of the given source type.

    The default is double, which is exact for integers up to 2**53.  A value that the type
    cannot hold becomes null.
    """
    target = SPARK_TYPES[check_type(as_type)]
    got = element(df, field, index).try_cast(target)
    # the widened unsigned types reach further than the source type
    if as_type.startswith("UInt"):
        limit = T.DecimalType(20, 0) if as_type == "UInt64" else target
        top = F.lit(str(2 ** (8 * type_size(as_type)) - 1)).cast(limit)
        got = F.when(got.between(F.lit(0).cast(limit), top), got)
    return got


def _replace(df: DataFrame, name: str, new: Column) -> DataFrame:
    """Replace a column, keeping its place, type and field metadata."""
    f = df.schema[name]
    new = new.cast(f.dataType).alias(name, metadata=f.metadata or {})
    return df.select(*[new if c == name else col(c) for c in df.columns])


def set_value(df: DataFrame, field: str, new, index: int = 0) -> DataFrame:
    """Replace a field, or one element of an array field."""
    new = new if isinstance(new, Column) else F.lit(new)
    f = df.schema[field]
    if is_array(f):
        at, item = F.lit(index), new.cast(f.dataType.elementType)
        return _replace(df, field, F.transform(col(field), lambda x, i: F.when(i == at, item).otherwise(x)))
    if index:
        raise IndexError(f"field {field!r} has one element, not {index + 1}")
    return _replace(df, field, new)


def clear(df: DataFrame) -> DataFrame:
    """Set every record field to its zero: 0, false or the empty string."""

    def zero(f: T.StructField) -> Column:
        base = f.dataType.elementType if is_array(f) else f.dataType
        if isinstance(base, T.StringType):
            z = F.lit("")
        elif isinstance(base, T.BooleanType):
            z = F.lit(False)
        else:
            z = F.lit(0).cast(base)
        z = F.transform(col(f.name), lambda _: z) if is_array(f) else z
        return z.alias(f.name, metadata=f.metadata or {})

    return df.select(*[zero(f) if is_record_field(f) or isinstance(f.dataType, T.StringType) else col(f.name) for f in df.schema])


def with_bits(df: DataFrame, field: str, bits: dict[str, int]) -> DataFrame:
    """Name bits of a plain integer column."""
    f = df.schema[field]
    meta = {"src_type": source_type(f), "count": 1, "bits": dict(bits)}
    return df.select(*[col(c).alias(c, metadata=meta) if c == field else col(c) for c in df.columns])


def bit(df: DataFrame, bit_name: str) -> Column:
    """A named bit as a boolean."""
    f, pos = find_bit(df.schema, bit_name)
    return F.getbit(col(f.name), F.lit(pos)) == 1


def bit_value(df: DataFrame, bit_name: str) -> Column:
    """A named bit as 0.0 or 1.0."""
    return bit(df, bit_name).cast("double")


def set_bit(df: DataFrame, bit_name: str, on) -> DataFrame:
    """Set or clear one named bit, leaving the others.

    ``on`` is a boolean or a number (not zero means set), fixed or per row.
    """
    f, pos = find_bit(df.schema, bit_name)
    width = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32, T.LongType(): 64}[f.dataType]
    mask = 1 << pos
    if pos == width - 1:
        mask -= 1 << width  # the sign bit of the Spark type
    mask = F.lit(mask).cast(f.dataType)
    word = col(f.name)
    on = (on if isinstance(on, Column) else F.lit(on)).cast("boolean")
    return _replace(df, f.name, F.when(on, word.bitwiseOR(mask)).otherwise(word.bitwiseAND(F.bitwise_not(mask))))


def expand_bits(df: DataFrame, field: str | None = None) -> DataFrame:
    """Add a 0/1 column for each named bit, of one word or of all of them."""
    words = [f for f in df.schema if named_bits(f) and field in (None, f.name)]
    return df.select(
        "*",
        *[F.getbit(col(f.name), F.lit(pos)).cast("int").alias(name) for f in words for name, pos in named_bits(f).items()],
    )


@dataclass(frozen=True)
class Channel:
    """One numeric track of a record."""

    name: str
    value: Column
    digital: bool = False


def channel_list(schema: T.StructType, skip: Sequence[str] = ()) -> list[Channel]:
    """The tracks of a schema that are one value a record: scalars, words and their named bits."""
    out = []
    for f in schema:
        if f.name in skip or not is_numeric(f) or is_array(f):
            continue
        c = col(f.name)
        out.append(Channel(f.name, c))
        out += [Channel(name, F.getbit(c, F.lit(pos)), True) for name, pos in named_bits(f).items()]
    return out


def channels(df: DataFrame, keep: Sequence[str] = (), skip: Sequence[str] = (), digital: bool = True) -> DataFrame:
    """Wide to long: one row per record and channel, ``[keep..., channel, y]``.

    ``keep`` columns are carried along; numeric ones among them are channels too unless
    listed in ``skip``.  A record becomes one list of its channels, arrays of whatever length included.
    """
    tracks = [t for t in channel_list(df.schema, skip) if digital or not t.digital]
    kind = "array<struct<channel:string,y:double>>"
    lists = [F.array(*[F.struct(F.lit(t.name).alias("channel"), t.value.cast("double").alias("y")) for t in tracks]).cast(kind)]
    for f in df.schema:
        if f.name not in skip and is_numeric(f) and is_array(f):
            name = lambda e: F.concat(e["field"], F.lit("["), e["index"].cast("string"), F.lit("]"))
            lists.append(F.transform(array_channels(f), lambda e: F.struct(name(e).alias("channel"), e["y"].alias("y"))).cast(kind))
    kept = [f"__keep{i}" for i in range(len(keep))]
    long = df.select(*[col(k).alias(a) for k, a in zip(keep, kept)], F.inline(F.concat(*lists)))
    return long.select(*[F.col(a).alias(k) for k, a in zip(keep, kept)], "channel", "y")


def array_channels(f: T.StructField) -> Column:
    """The elements of an array field as a list of ``field``, ``index``, ``y``."""
    one = lambda y, i: F.struct(F.lit(f.name).alias("field"), i.alias("index"), y.cast("double").alias("y"))
    return F.transform(col(f.name), one)


def explode_elements(df: DataFrame, field: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array field: ``[keep..., index, y]``."""
    return df.select(*[col(k) for k in keep], F.posexplode(col(field)).alias("index", "y"))
