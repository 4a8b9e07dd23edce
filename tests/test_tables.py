import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from millrace.functions.predicates import where
from millrace.sources import tables as W
from millrace.sources.files import ingest_rows, open_files
from millrace.sources.layout import RangePartition
from millrace.sources.sinks import write_parquet


def test_append_by_name_with_missing_columns(spark, pairs, database):
    name = f"{database}.t"
    W.write_table(pairs, name)
    W.insert(pairs.select("b", "a"), name)
    W.insert(spark.createDataFrame([(9,)], "b int"), name)
    assert rows(W.read_table(spark, name)) == sorted(rows(pairs) * 2 + [(None, 9)], key=repr)
    with pytest.raises(ValueError, match="no column z"):
        W.insert(pairs.withColumn("z", F.lit(1)), name)
    with pytest.raises(Exception):
        W.insert(pairs, f"{database}.absent")


def test_replace_fail_and_append(spark, pairs, database):
    name = f"{database}.t"
    W.write_table(pairs, name, "fail")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        W.write_table(pairs, name, "fail")
    W.write_table(pairs, name, "append")
    assert spark.table(name).count() == 6
    W.write_table(pairs.select("a"), name, "replace")
    assert rows(spark.table(name)) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        W.write_table(pairs, name, "sometimes")


def test_append_with_a_layout(spark, pairs, database):
    name = f"{database}.t"
    W.write_table(pairs, name, partition_by="a")
    W.write_table(pairs, name, partition_by="a", cluster_by="b")
    assert rows(spark.table(name)) == rows(pairs.union(pairs).select(*spark.table(name).columns))
    with pytest.raises(ValueError, match="partitioned by"):
        W.write_table(pairs, name, partition_by="b")
    with pytest.raises(ValueError, match="another time or range"):
        W.write_table(pairs, name, range_partition=RangePartition("a", 0, 10, 5))
    assert spark.table(name).count() == 6


def test_read_variants(spark, pairs, database):
    name = f"{database}.t"
    W.write_table(pairs, name)
    assert W.read_table(spark, name, limit=1).count() == 1
    assert rows(W.read_table(spark, name, ["a"], [("a", ">", 1), ("b", ">", 5)])) == [(3,)]
    assert W.read_table(spark, name, schema={"a": str}).dtypes == [("a", "string"), ("b", "bigint")]


def test_create_from_schema_makes_the_database(spark, database):
    name = f"{database}_new.t"
    schema = {"name": str, "age": int, "income": float, "is_student": bool, "created_at": dt.datetime, "details": {"address": str, "phone": str}}
    data = [
        ("Alice", 25, 50000.0, False, dt.datetime(2024, 1, 1), ("123 Main St", "555-1234")),
        ("Bob", 30, 20000.0, True, dt.datetime(2024, 1, 2), ("456 Elm St", "555-5678")),
    ]
    people = spark.createDataFrame(data, "name string, age bigint, income double, is_student boolean, created_at timestamp_ntz, details struct<address: string, phone: string>")
    W.create_table(spark, name, schema, people)
    found = W.read_table(spark, name, filters=[{"name": ["Alice", "Bob"]}, ("age", ">=", 25)], limit=10)
    assert rows(found) == rows(people)
    W.create_table(spark, name, schema, people)
    assert spark.table(name).count() == 4
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        W.create_table(spark, name, schema, exists_ok=False)


def test_time_partition_prunes_on_the_source_column(spark, database):
    name = f"{database}.t"
    df = spark.range(240).select("id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"))
    W.write_table(df, name, time_partition="ts", cluster_by=["id"])
    cases = [
        ("ts", ">=", dt.datetime(2024, 1, 9, 12)),
        ("ts", "<", dt.datetime(2024, 1, 2, 6)),
        ("ts", "=", dt.datetime(2024, 1, 2, 6)),
        ("ts", ">", "2024-01-10 20:00:00"),
        ("ts", "IN", [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)]),
        {"ts": dt.datetime(2024, 1, 1)},
        ("id", "=", 5),
    ]
    for item in cases:
        found = W.read_table(spark, name, filters=[item])
        assert rows(found) == rows(where(df, [item])) != [], item
        if item != ("id", "=", 5):
            assert "ts__day" in plan(found).split("PartitionFilters:")[1].split("\n")[0]
    assert W.read_table(spark, name).columns == ["id", "ts"]
    assert W.read_table(spark, name, ["ts__day"]).distinct().count() == 10
    W.insert(spark.createDataFrame([(999, dt.datetime(2024, 2, 1, 5))], "id int, ts timestamp_ntz"), name)
    assert rows(W.read_table(spark, name, ["id"], [("ts", ">=", dt.datetime(2024, 2, 1))])) == [(999,)]
    assert spark.table(name).where("ts__day = date '2024-02-01'").count() == 1


def test_days_do_not_depend_on_the_session_zone(spark, database):
    name, zone = f"{database}.t", spark.conf.get("spark.sql.session.timeZone")
    stamps = spark.range(96).select("id", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("ts"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        W.write_table(stamps, name, time_partition="ts")
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for hour in range(0, 96, 5):
            bound = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hour)
            for op in (">=", "<", "="):
                found = W.read_table(spark, name, ["id"], [("ts", op, bound)])
                assert rows(found) == rows(where(stamps, [("ts", op, bound)]).select("id")), (op, bound)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_range_partition_keeps_values_outside(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([(i,) for i in [-5, 0, 9, 10, 55, 99, 100, 1000]] + [(None,)], "k bigint")
    W.write_table(df, name, range_partition=RangePartition("k", 0, 100, 10))
    assert rows(W.read_table(spark, name)) == rows(df)
    assert {r[0] for r in spark.table(name).select("k__range").distinct().collect()} == {None, 0, 10, 50, 90}
    for item in [("k", "=", 55), ("k", "=", 1000), ("k", ">", 9), ("k", ">=", 10), ("k", "<", 10), ("k", "<=", 0), ("k", "IN", [-5, 99]), ("k", "<", 9.5), {"k": 10}]:
        assert rows(W.read_table(spark, name, filters=[item])) == rows(where(df, [item])), item
    with pytest.raises(ValueError):
        RangePartition("k", 10, 0, 5)
    with pytest.raises(ValueError):
        W.write_table(df, f"{database}.u", time_partition="k", range_partition=RangePartition("k", 0, 1, 1))


def test_copies(spark, pairs, database):
    W.write_table(pairs, f"{database}.t", partition_by="a")
    W.write_table(spark.sql("select 1 as id, timestamp_ntz '2024-01-01 10:00:00' as ts"), f"{database}.timed", time_partition="ts")
    W.copy_table(spark, f"{database}.t", f"{database}_two.t")
    assert rows(spark.table(f"{database}_two.t").select("a", "b")) == rows(pairs)
    assert W.partition_columns(spark, f"{database}_two.t") == ["a"]
    W.copy_table(spark, f"{database}.t", f"{database}_two.t")
    with pytest.raises(ValueError, match="already exists"):
        W.copy_table(spark, f"{database}.t", f"{database}_two.t", if_exists="fail")
    with pytest.raises(ValueError, match="onto itself"):
        W.copy_table(spark, f"{database}.t", f"{database}.t")
    assert sorted(W.copy_database(spark, database, f"{database}_three")) == ["t", "timed"]
    found = W.read_table(spark, f"{database}_three.timed", filters=[("ts", ">=", dt.datetime(2024, 1, 1))])
    assert found.columns == ["id", "ts"] and found.count() == 1
    assert "ts__day" in plan(found).split("PartitionFilters:")[1].split("\n")[0]


def test_columns_are_added_once(spark, database):
    name = f"{database}.t"
    W.create_table(spark, name, {"a": "INTEGER", "b": "INTEGER"})
    W.add_columns(spark, name, {"a": "INTEGER", "b": "INTEGER", "c": "STRING"})
    W.add_columns(spark, name, {"c": "STRING"})
    assert spark.table(name).dtypes == [("a", "bigint"), ("b", "bigint"), ("c", "string")]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_external_tables(spark, pairs, scratch, database, fmt):
    path, name = scratch(f"f.{fmt}"), f"{database}.x{fmt}"
    pairs.write.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(path)
    W.create_external(spark, name, path)
    assert rows(W.read_table(spark, name, schema={"a": int, "b": int}).select("a", "b")) == rows(pairs)
    W.create_external(spark, name, scratch("elsewhere.csv"))  # exists, so it is left alone
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        W.create_external(spark, name, path, exists_ok=False)
    spark.sql(f"DROP TABLE {name}")
    assert open_files(spark, path).count() == 3


def test_external_schema_and_partitions(spark, scratch, database):
    path = scratch("f.parquet")
    df = spark.createDataFrame([("007", 1), ("010", 2)], "code string, v int")
    df.write.partitionBy("code").parquet(path)
    W.create_external(spark, f"{database}.x", path)
    assert rows(W.read_table(spark, f"{database}.x", ["code", "v"])) == [("007", 1), ("010", 2)]
    assert rows(W.table_partitions(spark, f"{database}.x")) == [("007",), ("010",)]
    csv = scratch("f.csv")
    df.write.option("header", True).csv(csv)
    W.create_external(spark, f"{database}.c", csv, {"code": str, "v": str})
    assert rows(W.read_table(spark, f"{database}.c")) == [("007", "1"), ("010", "2")]


def test_partitions_from_the_catalog(spark, database):
    df = spark.createDataFrame([("a b", 1, 1), ("c/d=e", 2, 2), (None, 3, 3)], "s string, n int, v int")
    W.write_table(df, f"{database}.t", partition_by=["s", "n"])
    assert rows(W.table_partitions(spark, f"{database}.t")) == [("a b", 1), ("c/d=e", 2), (None, 3)]


def test_stats(spark, pairs, database):
    W.write_table(pairs, f"{database}.t")
    found = W.table_stats(spark, f"{database}.t").first()
    assert found["num_rows"] == 3 and found["num_bytes"] > 0


def test_names_are_checked(spark):
    assert W.quoted("d.t") == "`d`.`t`"
    for bad in ("a.b.c.d", "a..b", "a`; drop"):
        with pytest.raises(ValueError):
            W.quoted(bad)


def test_nulls_are_stored_as_booleans_and_times_as_text(spark, scratch, database):
    data = [
        {"a": 1, "nested": {"n1": True, "n3": None}, "d": None, "at": dt.time(1, 2, 3)},
        {"a": 2, "nested": {"n1": False, "n3": None}, "d": None, "at": None},
    ]
    df = ingest_rows(spark, data)
    assert dict(df.dtypes)["nested"] == "struct<n1:boolean,n3:void>"
    W.write_table(df, f"{database}.t")
    found = W.read_table(spark, f"{database}.t")
    assert found.dtypes == [("a", "bigint"), ("nested", "struct<n1:boolean,n3:boolean>"), ("d", "boolean"), ("at", "string")]
    assert rows(found.select("a", "nested.n3", "d", "at")) == [(1, None, None, "01:02:03"), (2, None, None, None)]
    write_parquet(df, scratch("f.parquet"))


def test_a_large_partition_is_written_by_several_tasks(spark, database):
    name, size = f"{database}.t", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    held = spark.conf.get(size)
    many = spark.range(0, 4_000_000, 1, 8).select(F.xxhash64("id").alias("v"), F.lit(1).alias("k"))  # 8 bytes a row that don't compress
    few = spark.range(10).select(F.col("id").alias("v"), F.lit(None).cast("int").alias("k"))
    W.write_table(many.union(few), name, partition_by=["k"])
    named = spark.table(name).select("k", F.input_file_name().alias("file"))
    files = named.groupBy("k").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))
    found = {r["k"]: (r["files"], r["n"]) for r in files.collect()}
    assert found[1][0] >= 2 and found[1][1] == 4_000_000 and found[None] == (1, 10)
    assert rows(W.table_partitions(spark, name)) == [(1,), (None,)]
    assert spark.conf.get(size) == held
