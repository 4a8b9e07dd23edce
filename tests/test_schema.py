import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import schema as S


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "a bigint, b string, c bigint")


def test_enforce_types_functions_and_maps(frame):
    rules = {"a": float, "b": S.per_element(lambda x: x.upper(), str), "c": {1: "one", 2: "two", 3: "three"}}
    expected = [(1.0, "A", "one"), (2.0, "B", "two"), (3.0, "C", "three")]
    assert rows(S.enforce(frame, rules)) == expected
    assert rows(S.enforce(frame, {**rules, "b": F.upper})) == expected
    assert rows(S.enforce(frame, {**rules, "b": S.per_batch(lambda s: s.str.upper(), str)})) == expected
    assert rows(S.enforce(frame)) == rows(frame)


def test_fallback_takes_the_first_rule_that_fits_all_values(spark):
    df = spark.createDataFrame([("1", "1"), ("2.5", "2"), (None, None)], "x string, y string")
    assert S.cast_failures(df, [("x", int), ("x", float), ("y", int)]) == [1, 0, 0]
    found = S.enforce(df, {"x": [int, float], "y": [int, float]})
    assert found.dtypes == [("x", "double"), ("y", "bigint")]
    assert rows(found) == [(1.0, 1), (2.5, 2), (None, None)]
    with pytest.raises(ValueError, match="no rule"):
        S.enforce(df, {"x": [int, dt.date]})
    assert S.enforce(df, {"x": [int, str]}).dtypes[0] == ("x", "string")
    assert rows(S.enforce(df, {"x": [int, {"2.5": "many"}]}).select("x")) == [("1",), ("many",), (None,)]


def test_errors_raise_or_leave_the_column(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.enforce(df, {"b": int}).collect()
    kept = S.enforce(df, {"a": int, "b": int}, errors="ignore")
    assert kept.dtypes == [("a", "bigint"), ("b", "string")]
    stored = S.enforce(df, {"a": str}, dtypes={"a": "int64", "b": "int64"}, errors="ignore")
    assert stored.dtypes == [("a", "string"), ("b", "string")]
    # A cast between types that never convert counts as a failure.
    dates = spark.sql("select date '2024-01-01' as d")
    assert S.enforce(dates, {"d": bool}, errors="ignore").dtypes == [("d", "date")]
    with pytest.raises(TypeError):
        S.enforce(df, {"a": 7})


def test_missing_columns_are_added_as_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert S.enforce(df, {"b": int, "c": {1: "one"}}).dtypes == [("a", "int"), ("b", "bigint"), ("c", "string")]
    wide = S.enforce(df, {"l": "array<string>", "s": "struct<x: int>"})
    assert wide.dtypes == [("a", "int"), ("l", "array<string>"), ("s", "struct<x:int>")]
    assert rows(S.add_missing(df, {"a": str, "b": [str]})) == [(1, None)]


def test_first_values_skip_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 7, None), (3, 8, "y")], "k int, a int, b string")
    assert rows(S.first_values(df, "k", ["a", "b"])) == [(7, "x")]
    assert rows(S.first_values(df, "k")) == [(1, 7, "x")]


def test_inference_of_text_columns(spark):
    data = [
        ("1", "1.5", "2024-01-02", "2024-01-02 03:04:05", "true", "a", None, "0", "1e3", "2024-01-02"),
        (None, "2", "2024-02-30"[:8] + "03", "2024-01-02T03:04", "False", "1", None, "", "2", "x"),
    ]
    names = ["i", "f", "d", "t", "b", "s", "n", "e", "x", "m"]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    found = dict(rows(S.infer_types(df)))
    assert found == {
        "i": "int", "f": "float", "d": "date", "t": "datetime", "b": "bool",
        "s": "str", "n": "null", "e": "str", "x": "float", "m": "str",
    }
    typed = spark.createDataFrame([(1, True, dt.datetime(2024, 1, 1), 0.0)], "a int, b boolean, c timestamp_ntz, d double")
    assert dict(rows(S.infer_types(typed))) == {"a": "int", "b": "bool", "c": "datetime", "d": "float"}


def test_best_types(spark):
    df = spark.createDataFrame([("1", "1.5", "x", None, 4.0), ("2", None, "y", None, 5.0)], "i string, f string, s string, n string, d double")
    assert S.best_types(df).dtypes == [("i", "bigint"), ("f", "double"), ("s", "string"), ("n", "string"), ("d", "double")]


def test_json_inference(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ('{"a": null, "d": [true]}',)], "j string")
    assert S.infer_json_type(df, "j").first()["type"] == "OBJECT<a: BIGINT, b: OBJECT<c: STRING>, d: ARRAY<BOOLEAN>>"
