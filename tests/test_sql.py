import datetime as dt

from conftest import rows

import __spark_entry__ as entry
from millrace.operators import sql


def test_parameters_keep_their_types(spark, pairs):
    found = sql.query(spark, "SELECT a FROM {t} WHERE a > :low AND array_contains(:some, b)", {"low": 1, "some": [4, 5]}, t=pairs)
    assert rows(found) == [(2,)]
    typed = sql.query(spark, "SELECT :flag AS f, :at AS t, :none AS n, :x AS x", {"flag": True, "at": dt.datetime(2024, 1, 1), "none": None, "x": 1.5})
    assert typed.dtypes == [("f", "boolean"), ("t", "timestamp_ntz"), ("n", "void"), ("x", "double")]


def test_result_schema(spark, pairs):
    found = sql.query(spark, "SELECT * FROM {t} WHERE a = 1", schema={"a": str, "b": float}, t=pairs)
    assert rows(found) == [("1", 4.0)]


def test_text_in_parameters_is_no_sql(spark, pairs):
    assert sql.query(spark, "SELECT * FROM {t} WHERE CAST(a AS STRING) = :v", {"v": "1' OR '1'='1"}, t=pairs).isEmpty()


def test_datetimes_without_a_zone_ignore_the_sessions(spark):
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-01 23:00:00', INTERVAL 1 HOUR)) AS ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    noon = dt.datetime(2024, 1, 1, 12)
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert sql.query(spark, "SELECT * FROM {h} WHERE ts >= :noon", {"noon": noon}, h=hours).count() == 12
            listed = sql.query(spark, "SELECT * FROM {h} WHERE array_contains(:at, ts)", {"at": [noon, dt.datetime(2024, 1, 1, 3)]}, h=hours)
            assert listed.count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_except_takes_away_customers_of_any_order(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "c_custkey bigint").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(1, 500000.0), (2, 100.0), (2, None), (9, 7.0)]
    spark.createDataFrame(orders, "o_custkey bigint, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert rows(entry.queries()["sql_f_except"](spark, str(tmp_path))) == [(3,), (None,)]
