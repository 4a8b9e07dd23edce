import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import types as T

from millrace.operators import dialects as D

FIRST = {"a": "int", "b": "str", "c": "float"}


def descriptions(spark, tables):
    data = [(t, path, kind) for t, columns in tables.items() for path, kind in columns.items()]
    return spark.createDataFrame(data, "table_name string, path string, type string")


TABLES = {
    "py": {"a": str(int), "b": str(str), "c": str(float)},
    "st": FIRST,
    "wh": {"a": "INTEGER", "b": "STRING", "c": "FLOAT"},
    "pd": {"a": "Int64", "b": "string", "c": "Float64"},
    "mixed": {"a": "int", "b": "int64"},
    "partial": {"a": "int", "b": "ints"},
    "none": {"a": "x", "b": "y"},
    "several": {"a": "string"},
    "frame": {"a": "int64", "b": "object", "c": "float64"},
}


def test_detection(spark):
    found = dict(rows(D.detect_dialects(descriptions(spark, TABLES))))
    assert found == {
        "py": "python", "st": "str", "wh": "warehouse", "pd": "pandas",
        "mixed": None, "partial": None, "none": None, "several": None, "frame": None,
    }


def test_match_counts(spark):
    counts = {(t, d): n for t, d, n in rows(D.type_match_counts(descriptions(spark, TABLES)))}
    assert len(counts) == len(TABLES) * 5
    assert [counts["st", d] for d in ("warehouse", "python", "str")] == [0, 0, 3]
    assert [counts["py", d] for d in ("warehouse", "python", "str")] == [0, 3, 0]
    assert [counts["frame", d] for d in ("warehouse", "python", "str", "pandas")] == [0, 0, 0, 1]
    assert [counts["mixed", d] for d in ("pandas", "str")] == [0, 1]


# name, warehouse, python, pandas, arrow
NESTED = [
    ("name", "str", "STRING", "<class 'str'>", "string", "string"),
    ("age", "int", "INTEGER", "<class 'int'>", "Int64", "int64"),
    ("income", "float", "FLOAT", "<class 'float'>", "Float64", "double"),
    ("is_student", "bool", "BOOLEAN", "<class 'bool'>", "boolean", "bool"),
    ("created_at.date", "date", "DATE", "<class 'datetime.date'>", "datetime64[ns]", "date32"),
    ("created_at.time", "time", "TIME", "<class 'datetime.time'>", "datetime64[ns]", "time64[ns]"),
    ("details", "struct", "STRUCT", "<class 'dict'>", "struct", "struct"),
    ("details.phone", "int", "INTEGER", "<class 'int'>", "Int64", "int64"),
    ("seen", "timestamp", "TIMESTAMP", "<class 'datetime.datetime'>", "datetime64[ns]", "timestamp[ns]"),
    ("at", "datetime", "DATETIME", "<class 'datetime.datetime'>", "datetime64[ns]", "timestamp[ns]"),
    ("nothing", "null", "BOOLEAN", "<class 'NoneType'>", "object", "null"),
]


@pytest.mark.parametrize("target,place", [("warehouse", 2), ("python", 3), ("pandas", 4), ("arrow", 5)])
def test_translation_from_canonical(spark, target, place):
    columns = descriptions(spark, {"t": {row[0]: row[1] for row in NESTED}})
    found = {path: kind for _, path, kind in rows(D.translate_types(columns, target))}
    assert found == {row[0]: row[place] for row in NESTED}


def test_inverses_keep_the_last_name(spark):
    columns = descriptions(spark, {"t": {"a": "timestamp[ns]", "b": "int64"}})
    assert [r[2] for r in rows(D.translate_types(columns, "str", "arrow"))] == ["datetime", "int"]
    columns = descriptions(spark, {"t": {"a": "BOOLEAN", "b": "RECORD"}})
    assert [r[2] for r in rows(D.translate_types(columns, "str", "warehouse"))] == ["bool", "struct"]
    columns = descriptions(spark, {"t": {"a": "datetime64[ns]", "b": "bytes"}})
    assert [r[2] for r in rows(D.translate_types(columns, "str", "pandas"))] == ["datetime", "bytes"]


def test_unknown_names(spark):
    columns = descriptions(spark, {"t": {"a": "NUMERIC"}})
    with pytest.raises(Exception, match="unknown type name: NUMERIC"):
        D.translate_types(columns, "str", "warehouse").collect()
    assert rows(D.translate_types(columns, "str", "warehouse", errors="null")) == [("t", "a", None)]
    with pytest.raises(ValueError):
        D.translate_types(columns, "elsewhere")


def test_spark_types():
    assert D.spark_type("int") == D.spark_type(int) == D.spark_type("INTEGER") == D.spark_type("Int64") == T.LongType()
    assert D.spark_type("datetime") == D.spark_type(dt.datetime) == T.TimestampNTZType()
    assert D.spark_type("TIMESTAMP") == T.TimestampType()
    assert D.spark_type("decimal(10,2)") == T.DecimalType(10, 2)
    nested = D.spark_type({"a": int, "b": [str], "n": {"a": "int", "b": ["str"]}})
    assert nested.simpleString() == "struct<a:bigint,b:array<string>,n:struct<a:bigint,b:array<string>>>"
    assert all(field.nullable for field in nested.fields)
    for bad in (list, "struct", [int, str]):
        with pytest.raises(ValueError):
            D.spark_type(bad)


def test_described_columns_name_the_canonical_types(spark):
    df = spark.createDataFrame([], "a bigint, b array<string>, nested struct<a: int, b: array<string>>, d double, t timestamp_ntz")
    assert {path: kind for _, path, kind in rows(D.describe_columns(df, "t"))} == {
        "a": "int", "b": "array", "b[]": "str", "nested": "struct", "nested.a": "int",
        "nested.b": "array", "nested.b[]": "str", "d": "float", "t": "datetime",
    }


def test_types_of_values():
    assert D.type_of_values([None, True]) == T.BooleanType()
    assert D.type_of_values([0, 1]) == T.LongType()
    assert D.type_of_values([0, 1.5]) == T.DoubleType()
    assert D.type_of_values([None]) == T.NullType()
    nested = D.type_of_values([{"n1": True, "n3": None}, {"n1": False, "n2": [1]}])
    assert nested.simpleString() == "struct<n1:boolean,n3:void,n2:array<bigint>>"
    with pytest.raises(ValueError):
        D.type_of_values([1, "a"])
