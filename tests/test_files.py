import os

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import files as S
from millrace.sources import sinks


@pytest.mark.parametrize(
    "path,fmt",
    [
        ("a/b.parquet", "parquet"), ("a/b.parquet/", "parquet"), ("b.parquet/*", "parquet"), ("x.csv", "csv"),
        ("x.json", "json"), ("x.avro", "avro"), ("x.orc", "orc"),
    ],
)
def test_formats_by_suffix(path, fmt):
    assert S.infer_format(path) == fmt


def test_unknown_suffix():
    with pytest.raises(ValueError):
        S.infer_format("a/b.txt")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_each_format_reads_back(spark, pairs, scratch, fmt):
    path = scratch(f"pairs.{fmt}")
    pairs.write.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(path)
    read = S.read_files(spark, path, schema={"a": int, "b": int})
    assert rows(read.select("a", "b")) == rows(pairs)
    assert rows(S.read_files(spark, path, file_schema={"a": int, "b": int}).select("a", "b")) == rows(pairs)


def test_read_variants(spark, pairs, scratch):
    path = scratch("pairs.parquet")
    sinks.write_parquet(pairs, path)
    assert S.read_files(spark, path, limit=1).count() == 1
    assert S.read_files(spark, path, columns=["a"]).columns == ["a"]
    assert rows(S.read_files(spark, path, ["a"], [("a", ">", 1)])) == [(2,), (3,)]
    assert rows(S.read_files(spark, path, ["a"], [("a", ">", 1), ("b", ">", 5)])) == [(3,)]
    text = plan(S.read_files(spark, path, ["a"], [("b", ">", 5)]))
    assert "GreaterThan(b,5)" in text and "ReadSchema: struct<a:bigint,b:bigint>" in text


def test_partition_folders_and_pruning(spark, pairs, scratch):
    path = scratch("pairs.parquet")
    sinks.write_parquet(pairs, path, partition_by="a")
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["a=1", "a=2", "a=3"]
    assert rows(spark.read.parquet(f"{path}/a=1")) == [(4,)]
    read = S.read_parquet(spark, path, filters=[("a", "=", 2)])
    assert rows(read.select("a", "b")) == [(2, 5)]
    assert "PartitionFilters: [isnotnull(a" in plan(read)


def test_all_columns_may_be_partition_columns(spark, pairs, scratch):
    path = scratch("pairs.parquet")
    sinks.write_parquet(pairs, path, partition_by=["a", "b"])
    assert rows(S.read_partition_values(spark, path, {"a": int, "b": int})) == rows(pairs)
    assert rows(S.read_parquet(spark, path).select("a", "b")) == rows(pairs)


def test_partition_values_stay_text_and_open_no_file(spark, scratch):
    path = scratch("odd.parquet")
    df = spark.createDataFrame([("007", "a b", 1), ("010", "c/d", 2), ("1", None, 3), ("007", "a b", 4)], "code string, name string, v int")
    sinks.write_parquet(df, path, partition_by=["code", "name"])
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    values = S.read_partition_values(spark, path)
    assert rows(values) == [("007", "a b"), ("010", "c/d"), ("1", None)]
    assert "ReadSchema: struct<>" in plan(values) and "binaryFile" in plan(values)
    external = S.read_external(spark, path, filters=[("code", "=", "007")])
    assert rows(external.select("v", "code", "name")) == [(1, "007", "a b"), (4, "007", "a b")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == before
    with pytest.raises(ValueError):
        S.read_partition_values(spark, os.path.join(path, "code=1", "name=__HIVE_DEFAULT_PARTITION__"))


def test_missing_paths_are_empty(spark, scratch):
    empty = S.read_parquet(spark, scratch("no.parquet"), schema={"a": int, "b": str}, filters=[("a", ">", 1)], columns=["b"])
    assert empty.isEmpty() and empty.schema == T.StructType([T.StructField("b", T.StringType())])
    assert S.read_parquet(spark, scratch("no.parquet"), filters=[("a", ">", 1)], columns=["b"]).columns == []
    with pytest.raises(ValueError, match="allow_empty"):
        S.read_parquet(spark, scratch("no.parquet"), allow_empty=False)


def test_round_trip_of_partitioned_frame(spark, scratch):
    path = scratch("f.parquet")
    df = spark.createDataFrame([(1, "a", 1.1), (2, "b", 2.2), (3, "c", 3.3), (4, "d", 4.4)], "A bigint, B string, C double")
    sinks.write_parquet(df, path, partition_by=["A", "B"], cluster_by=["C"])
    assert rows(S.read_parquet(spark, path, schema="C double, A bigint, B string").select("A", "B", "C")) == rows(df)


def test_write_schema_is_enforced(spark, pairs, scratch):
    path = scratch("f.parquet")
    sinks.write_parquet(pairs, path, schema={"a": str})
    assert spark.read.parquet(path).dtypes == [("a", "string"), ("b", "bigint")]


def test_cluster_columns_keep_value_ranges_apart(spark, scratch):
    path = scratch("f.parquet")
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 5).otherwise(F.col("id") % 50).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_parquet(df, path, cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n")
    ).orderBy("low", "high").collect()
    # The hot value spans several files, and the ranges of the files do not overlap.
    assert sum(f["low"] <= 5 <= f["high"] for f in files) > 3
    assert all(a["high"] <= b["low"] for a, b in zip(files, files[1:]))
    assert sum(f["n"] for f in files) == 20_000


def test_objects_texts_and_inventory(spark, scratch):
    path = scratch("objects")
    df = spark.createDataFrame([(1, "one\ntwo"), (2, "three")], "k int, t string")
    sinks.write_texts(df, path, "t", one_object_per="k")
    texts = S.read_texts(spark, path)
    assert rows(texts.select("k", "text")) == [(1, "one\ntwo\n"), (2, "three\n")]
    found = S.file_inventory(spark, path, "*.txt")
    assert found.columns == ["path", "length", "modificationTime"] and found.count() == 2
    assert "ReadSchema: struct<length:bigint>" in plan(found.select("length"))
    assert rows(S.list_folder(found, path)) == [("k=1", True, 8), ("k=2", True, 6)]
    assert S.file_inventory(spark, path, "*.csv").isEmpty()
    deep = spark.createDataFrame([("file:/x/y/x/y/z.txt", 3), ("file:/x/y/a.txt", 2)], "path string, length bigint")
    assert rows(S.list_folder(deep, "/x/y")) == [("a.txt", False, 2), ("x", True, 3)]


def test_messages(spark, pairs, scratch):
    assert rows(sinks.messages(pairs)) == [('{"a":1,"b":4}',), ('{"a":2,"b":5}',), ('{"a":3,"b":6}',)]
    assert rows(sinks.messages(pairs, columns=["b"])) == [('{"b":4}',), ('{"b":5}',), ('{"b":6}',)]
    assert rows(sinks.messages(spark.sql("select 'data' as d"), payload="d")) == [("data",)]
    path = scratch("topic")
    sinks.publish(pairs, path)
    sinks.publish(pairs, path, payload="a")
    assert spark.read.text(path).count() == 6


def test_ingest(spark):
    import pandas as pd

    expected = [(1, 4), (2, 5), (3, 6)]
    for data in (
        {"a": [1, 2, 3], "b": [4, 5, 6]},
        [{"a": 1, "b": 4}, {"a": 2, "b": 5}, {"b": 6, "a": 3}],
        pd.DataFrame({"a": [1, 2, 3], "b": [4, 5, 6]}),
    ):
        assert rows(S.ingest_rows(spark, data)) == expected
    assert rows(S.ingest_rows(spark, {"a": 1, "b": "x"})) == [(1, "x")]
    data = {
        "name": ["Alice", "Bob", "Charlie"], "age": [25, 30, 35], "income": [50000.0, 20000.0, 30000.0],
        "is_student": [None, None, False],
    }
    assert S.ingest_rows(spark, data).dtypes == [("name", "string"), ("age", "bigint"), ("income", "double"), ("is_student", "boolean")]
    assert rows(S.ingest_rows(spark, [{"a": 0}, {"b": ""}])) == [(0, None), (None, "")]
    nested = S.ingest_rows(spark, [{"a": 1, "d": {"x": "y", "z": [1]}}])
    assert nested.dtypes == [("a", "bigint"), ("d", "struct<x:string,z:array<bigint>>")]
    assert S.ingest_rows(spark, [{"a": 1}], {"a": int, "b": str}).dtypes == [("a", "bigint"), ("b", "string")]
    with pytest.raises(ValueError):
        S.ingest_rows(spark, {"a": [1, 2], "b": [1]})
