import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import names, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_names(spark):
    full = F.lit("projects/p/locations/eu/lakes/l/zones/z")
    assert one(spark, names.shorten(full)) == "p/eu/l/z"
    assert one(spark, names.shorten(full, 2)) == "l/z"
    assert one(spark, names.last_segment(F.lit("a/b/c"))) == "c"
    assert one(spark, names.last_segment(F.lit("c"))) == "c"


@pytest.mark.parametrize(
    "value,expected",
    [("t", (None, None, "t")), ("d.t", (None, "d", "t")), ("p.d.t", ("p", "d", "t")), ("a.p.d.t", None)],
)
def test_table_id(spark, value, expected):
    found = one(spark, names.table_id_parts(F.lit(value)))
    assert (tuple(found) if found is not None else None) == expected


def test_partition_values_are_decoded(spark):
    found = one(spark, names.partition_values(F.lit("/lake/t.parquet/a=1/b=c%2Fd/e=x+y%20z/part.parquet")))
    assert found == {"a": "1", "b": "c/d", "e": "x+y z"}


def test_log_text(spark):
    ts = F.lit("2024-01-02 03:04:05.678912").cast("timestamp_ntz")
    assert one(spark, text.timestamp_label(ts)) == "2024-01-02 03:04:05.678 UTC"
    assert one(spark, text.message_text(F.lit('{"message": "hi", "a": 1}'))) == "hi"
    assert one(spark, text.message_text(F.lit('{"a": 1}'))) == '{"a": 1}'
    assert one(spark, text.message_text(F.lit("plain"))) == "plain"
    assert one(spark, text.log_line(ts, F.lit("plain"))) == "LogEntry - [2024-01-02 03:04:05.678 UTC] plain"


def test_value_maps(spark):
    df = spark.createDataFrame([(1, "a"), (9, None)], "n bigint, s string")
    assert rows(df.select(text.map_values(F.col("n"), {1: "one"}))) == [("9",), ("one",)]
    assert rows(df.select(text.map_values(F.col("n"), {1: 7}))) == [(7,), (9,)]
    assert rows(df.select(text.map_values(F.col("s"), {None: "none", "a": "A"}))) == [("A",), ("none",)]
    assert rows(df.select(text.map_values(F.col("s"), {}))) == [("a",), (None,)]


def test_statuses(spark):
    def status(attempt, code):
        return one(spark, text.attempt_status(F.lit(attempt).cast("timestamp"), F.lit(code).cast("int")))

    assert status(None, 0) == "Has not run yet"
    assert status("2024-01-01", None) == status("2024-01-01", 0) == "Success"
    assert status("2024-01-01", 2) == "Failed"
    assert status("2024-01-01", 5) == "5"
    assert one(spark, text.traffic_status(F.lit(1))) == "Active"
    assert one(spark, text.traffic_status(F.lit(0))) == "Inactive"


def test_payload_keeps_nulls_and_microseconds(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 2, 3, 4, 5, 678912))], "a int, b string, t timestamp_ntz")
    assert df.select(text.json_payload()).first()[0] == '{"a":1,"b":null,"t":"2024-01-02T03:04:05.678912"}'


def test_underscores(spark):
    assert one(spark, text.underscores_to_spaces(F.lit("a_b c"))) == "a b c"


def test_guarded_casts_equal_try_cast(spark):
    from pyspark.sql import types as T

    from millrace.functions.casts import GUARDS, cast_or_null

    values = [
        "1", " 1 ", "+1", "-1", "1.5", ".5", "5.", "1e3", "1E-3", "1d", "1.5f", "0x1p3", "NaN", "nan", "Inf", "-infinity", "+inf",
        "Infinity", "99999999999999999999", "", " ", "a", "1a", "1 2", "--1", "2024", "2024-1", "2024-01-02", " 2024-1-2 ",
        "2024-01-02 ", "2024-01-02T", "2024-01-02 03:04", "2024-01-02T03:04:05.678901Z", "2024-13-01", "12:30", "T12:30:15",
        "1:2:3", "+2024-01-02", "-2024-01-02", "12345-01-01", "t", "TRUE", "yes", "Y", "no", "F", "0", "2", "now", "today", "epoch",
        "2024-01-02\n", "\t7", "1,000", "0.0", "1.e5", "1e", "+", ".", "-", "2024-01-02 03:04:05 UTC", None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    value = F.col("v")
    for kind in GUARDS:
        target = T.DecimalType(20, 3) if kind is T.DecimalType else kind()
        guarded = cast_or_null(value, T.StringType(), target)
        same = guarded.eqNullSafe(value.try_cast(target))
        assert [r["v"] for r in df.where(~same).collect()] == [], kind


def test_map_values_of_texts_to_numbers(spark):
    from millrace.operators.schema import enforce

    df = spark.createDataFrame([("a",), ("b",)], "s string")
    assert rows(enforce(df, {"s": {"a": 1}})) == [("1",), ("b",)]


def test_rows_of_whole_and_broken_numbers(spark):
    from millrace.sources.files import ingest_rows

    assert rows(ingest_rows(spark, {"w": [1, 2.5, None]})) == [(1.0,), (2.5,), (None,)]
