import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from millrace.functions import predicates as P


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("Alice", 25, 1.5, ("1 Main", "x")), ("Bob", 30, None, ("2 Elm", "y")), ("Carl", None, 3.0, (None, "z"))],
        "name string, age bigint, income double, details struct<address string, phone string>",
    )


def names(df):
    return sorted(row["name"] for row in df.collect())


def test_comparisons_are_joined_by_and(people):
    assert names(P.where(people, [("age", ">", 24), ("age", "<", 30)])) == ["Alice"]
    assert names(P.where(people, [("age", ">=", 25), ("age", "<=", 30)])) == ["Alice", "Bob"]
    assert names(P.where(people, [("name", "=", "Bob")])) == ["Bob"]
    assert names(P.where(people, [])) == ["Alice", "Bob", "Carl"]
    assert names(P.where(people, None)) == ["Alice", "Bob", "Carl"]


def test_membership_and_dict_filters(people):
    assert names(P.where(people, [{"name": ["Alice", "Bob"]}, ("age", ">=", 26)])) == ["Bob"]
    assert names(P.where(people, [{"name": "Bob", "age": [30, 31]}])) == ["Bob"]
    assert names(P.where(people, {"name": "Bob", "age": 25})) == []
    assert names(P.where(people, [("age", "IN", [])])) == []
    assert names(P.where(people, [("age", "in", [25, None])])) == ["Alice"]
    assert P.membership({"a": [1, 2], "b": [3, 4], "c": 5}) == [("a", "in", [1, 2]), ("b", "in", [3, 4]), ("c", "in", [5])]
    assert P.membership(None) is None and P.membership([("a", "=", 1)]) == [("a", "=", 1)]


def test_like_nested_fields_and_equality(people):
    assert names(P.where(people, [("name", "like", "%li%")])) == ["Alice"]
    assert names(P.where(people, [("details.address", "LIKE", "%Elm")])) == ["Bob"]
    assert names(P.where_equal(people, {"age": 25, "income": 1.5})) == ["Alice"]
    assert names(P.where_equal(people, None)) == ["Alice", "Bob", "Carl"]


def test_file_filters_take_or_of_ands(people):
    groups = [[("age", "==", 25)], [("income", "!=", 1.5), ("name", "not in", ["Bob"])]]
    assert names(P.where_file(people, groups)) == ["Alice", "Carl"]
    assert names(P.where_file(people, [("age", "!=", 25)])) == ["Bob"]


@pytest.mark.parametrize(
    "item",
    [("age", "!=", 1), ("age", "OR 1=1", 1), ("salary", "=", 1), ("age", "=", [1, 2]), ("details.city", "=", "x")],
)
def test_bad_filters_raise(people, item):
    with pytest.raises(ValueError):
        P.where(people, [item])


def test_odd_text_is_data(spark):
    df = spark.createDataFrame([("a--b",), ("`c`",)], "name string")
    assert names(P.where(df, [("name", "=", "a--b")])) == ["a--b"]
    assert names(P.where(df, [("name", "IN", ["`c`"])])) == ["`c`"]


def test_datetimes_follow_the_column_type(spark):
    df = spark.sql("select timestamp_ntz '2024-01-10 00:00:00' as n, timestamp '2024-01-10 00:00:00+00:00' as z, date '2024-01-10' as d, 'r' as name")
    naive, aware = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)
    for column, value in [("n", naive), ("n", aware), ("z", aware), ("d", dt.date(2024, 1, 10)), ("d", naive)]:
        assert names(P.where(df, [(column, ">=", value), (column, "<=", value)])) == ["r"], (column, value)


def test_predicates_reach_the_scan(spark, scratch):
    path = scratch("events.parquet")
    spark.sql("select id, timestamp_ntz '2024-01-01' as ts, cast(id as string) as s from range(10)").write.parquet(path)
    df = P.where(spark.read.parquet(path), [("ts", ">=", dt.datetime(2024, 1, 1)), {"id": [1, 2]}, ("s", "like", "%1%")])
    text = plan(df.select("id"))
    for pushed in ("GreaterThanOrEqual(ts,2024-01-01T00:00)", "In(id, [1,2])", "StringContains(s,1)"):
        assert pushed in text


def test_prefixes_states_and_all_elements(spark):
    df = spark.createDataFrame(
        [("test_a", [1, 2]), ("temp_b", [0, 1]), ("keep", []), ("example_c", None), ("test-d", [None, 1])],
        "name string, percents array<int>",
    )
    assert names(df.where(P.starts_with_any(F.col("name"), ["test_", "test-", "temp_", "example_"]))) == [
        "example_c", "temp_b", "test-d", "test_a",
    ]
    assert names(df.where(P.every(F.col("percents"), lambda p: p > 0))) == ["example_c", "keep", "test_a"]
    assert rows(df.where(P.in_state(F.col("name"), "keep")).select("name")) == [("keep",)]
