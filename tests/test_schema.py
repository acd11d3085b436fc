import pytest
from pyspark.sql import types as T

from recspark.schema import (
    bit_positions, element_count, field, find_bit, named_bits, record_dtype, record_schema, source_type, type_size,
)
from recspark.sources.recordings import read_recordings, write_recordings


def offsets(schema, align=False):
    dtype = record_dtype(schema, align)
    return {n: dtype.fields[n][1] for n in dtype.names}, dtype.itemsize


def test_packed_layout():
    schema = record_schema([("IntVal", "Int32"), ("DblVal", "Double"), ("StrVal", "Char", 10)])
    at, size = offsets(schema)
    assert at == {"TimeStamp": 0, "IntVal": 8, "DblVal": 12, "StrVal": 20}
    assert size == 30


def test_aligned_layout():
    schema = record_schema([("SmallVal", "Int8"), ("BigVal", "Double"), ("MedVal", "Int32")], align=True)
    at, size = offsets(schema, align=True)
    assert at == {"TimeStamp": 0, "BigVal": 8, "MedVal": 16, "SmallVal": 20}
    assert size % 8 == 0


def test_timestamp_comes_first_and_names_are_found():
    schema = record_schema([("V", "Float"), field("W", "UInt64")])
    assert schema.names == ["TimeStamp", "V", "W"]
    assert len(schema) == 3 and "V" in schema.names
    assert source_type(schema["V"]) == "Float"
    assert schema["W"].dataType == T.DecimalType(20, 0)


def test_array_and_text_fields():
    schema = record_schema([("Arr", "Int16", 4), ("Name", "Char", 8)])
    assert schema["Arr"].dataType == T.ArrayType(T.ShortType(), False)
    assert element_count(schema["Arr"]) == 4
    assert schema["Name"].dataType == T.StringType()


def test_bits_run_from_the_lowest_and_numbers_skip():
    assert bit_positions(["tx", "rx", "4", "errFlag"]) == {"tx": 0, "rx": 1, "errFlag": 6}
    schema = record_schema([("StatusReg", "UInt8", ["tx", "rx", 4, "errFlag"])])
    word, pos = find_bit(schema, "errFlag")
    assert (word.name, pos) == ("StatusReg", 6)
    with pytest.raises(KeyError):
        find_bit(schema, "nope")


def test_schema_survives_json():
    schema = record_schema([("A", "Int8", 2), ("W", "UInt16", ["a", "3", "b"])])
    back = T.StructType.fromJson(schema.jsonValue())
    assert named_bits(back["W"]) == {"a": 0, "b": 4} and element_count(back["A"]) == 2


@pytest.mark.parametrize(
    "specs",
    [
        [("A",)], [("A", "Int8", 1, 2)], [("A", "Ptr")], [("A", "Void")], [("A", "Undefine")], [("A", "Int8", 0)],
        [("A", "Float", ["bit"])], [("A", "Int8", ["8", "ninth"])], [("A", "Int8"), ("A", "Int16")],
        [("A", "Int8", ["x"]), ("B", "Int8", ["x"])], [("TimeStamp", "Double")],
    ],
)
def test_bad_specs(specs):
    with pytest.raises(ValueError):
        record_schema(specs)


def test_long_names_stay_whole(spark, tmp_path):
    name = "x" * 40
    assert field(name, "Int8").name == name
    df = spark.createDataFrame([(1.0, 5)], record_schema([(name, "Int32")]))
    write_recordings(df, str(tmp_path / "r"))
    assert read_recordings(spark, str(tmp_path / "r")).select(name).first()[0] == 5


def test_a_bit_is_not_named_like_a_field():
    with pytest.raises(ValueError):
        record_schema([("a", "UInt8", ["b"]), ("b", "Int8")])


def test_type_sizes():
    assert [type_size(t) for t in ("Bool", "Char", "Int16", "UInt32", "Int64", "Float", "Double")] == [1, 1, 2, 4, 8, 4, 8]
