import datetime as dt

import pytest
from conftest import rows
from millrace.functions import text
from millrace.operators import documents, reshape, schema
from millrace.streaming import streams
from pyspark.sql import functions as F


@pytest.fixture
def new_york(spark):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", held)


def test_offsets_make_timestamps(spark):
    zoned = ["2024-01-01 10:00:00+05:00", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00 Europe/Berlin", None]
    naive = ["2024-01-01 10:00:00", "2024-01-01T10:00", "2024-01-01", "2024-01-01 10:00:00.125 "]
    frame = spark.createDataFrame(list(zip(zoned, naive, [zoned[0], naive[0], None, None], ["2024-01-01 10:00:00?", None, None, None])), "z string, n string, m string, o string")
    assert dict(rows(schema.infer_types(frame))) == {"z": "timestamp", "n": "datetime", "m": "str", "o": "str"}
    best = schema.best_types(frame)
    assert dict(best.dtypes) == {"z": "timestamp", "n": "timestamp_ntz", "m": "string", "o": "string"}
    seconds = [r[0] for r in best.select(F.unix_seconds("z")).collect()]
    assert seconds == [1704085200, 1704103200, 1704099600, None]


def test_labels_are_in_the_zone_that_they_name(spark, new_york):
    frame = spark.sql("SELECT TIMESTAMP '2024-01-01 12:00:00.1239Z' AS ts, TIMESTAMP_NTZ '2024-07-01 12:00:00' AS plain, '{\"message\": \"m\"}' AS p")
    got = frame.select(
        text.timestamp_label(F.col("ts")), text.timestamp_label(F.col("ts"), "Asia/Tokyo"), text.timestamp_label(F.col("plain")), text.log_line(F.col("ts"), F.col("p"))).first()
    assert tuple(got) == ("2024-01-01 12:00:00.123 UTC", "2024-01-01 21:00:00.123 Asia/Tokyo", "2024-07-01 12:00:00.000 UTC", "LogEntry - [2024-01-01 12:00:00.123 UTC] m")


def test_members_come_in_the_order_of_the_text(spark):
    texts = ['{"b":1,"a":2}', '{"z":{"y":[1.50,{"x":true}],"b":{}},"a":null,"c":"{\\"no\\":1}"}', "[]", "7", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, doc string")
    values = reshape.flatten_values(frame, "doc", ["id"]).orderBy("id", "place")
    assert [r["value"] for r in values.where("id = 0").collect()] == ["1", "2"]
    assert [(r["place"], r["value"]) for r in values.where("id = 1").collect()] == [([0, 0, 0], "1.50"), ([0, 0, 1, 0], "true"), ([1], None), ([2], '{"no":1}')]
    assert [r["value"] for r in values.where("id > 1").collect()] == ["7"]
    keys = reshape.flatten_keys(frame, "doc", ["id"]).orderBy("id", "place")
    assert [r["key"] for r in keys.collect()] == ["b", "a", "z", "y", "x", "b", "a", "c"]
    assert "Join" not in values._jdf.queryExecution().executedPlan().toString()
    deep = spark.createDataFrame([(0, "[" * 500 + "1" + "]" * 500)], "id long, doc string")
    assert [len(r["place"]) for r in reshape.flatten_values(deep, "doc", ["id"]).collect()] == [500]
    with pytest.raises(Exception, match="deeper than 3"):
        reshape.flatten_values(deep, "doc", ["id"], depth=3).collect()


def test_documents_without_data(spark):
    frame = spark.createDataFrame([(1, '{"data": {"a": {"0": 5}}}'), (2, '{"x": 1}'), (3, '{"data": {}}'), (4, None), (5, "{")], "_d long, document string")
    with pytest.raises(Exception, match="no JSON or has no data"):
        documents.unpack_documents(frame.where("_d = 2"), dtypes={"a": "int64"}).collect()
    got = documents.unpack_documents(frame, dtypes={"a": "int64"}, errors="ignore")
    assert rows(got) == [(1, 5), (2, None), (5, None)]


def test_each_document_keeps_its_types(spark):
    frame = spark.createDataFrame([("x", "1"), ("y", "2.5"), ("z", "3"), ("z", None)], "doc string, v string")
    typed = documents.variant_types(documents.variant_documents(frame, "doc", {"x": {"v": int}, "y": {"v": float}}), ["v"])
    assert rows(typed.select("doc", "v_type", F.to_json("v"))) == [("x", "BIGINT", "1"), ("y", "DOUBLE", "2.5"), ("z", "STRING", '"3"'), ("z", None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        documents.variant_documents(frame, "doc", {"y": {"v": int}}).collect()


def test_columns_named_like_working_columns(spark):
    frame = spark.createDataFrame([(k % 2, k, -k) for k in range(6)], "_row long, _position long, _id long")
    packed = reshape.rows_to_columns(frame, "_row", "_position", ["_position", "_id"])
    back = reshape.columns_to_rows(packed, ["_position", "_id"]).select("_row", "_position", "_id")
    assert rows(back) == rows(frame)
    documents_ = documents.pack_documents(frame.withColumnsRenamed({"_row": "_d", "_id": "_bad"}), "_d", "_position")
    assert rows(documents.unpack_documents(documents_).select("_d", "_position", "_bad")) == rows(frame)


def test_inverting_keeps_the_last_of_equal_values(spark):
    got = spark.sql("SELECT map('a', 1, 'b', 2, 'c', 1, 'd', NULL, 'e', 2) AS m").select(reshape.invert_map(F.col("m")).alias("m")).first()["m"]
    assert got == {1: "c", 2: "e"}
