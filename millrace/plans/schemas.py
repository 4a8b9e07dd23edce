"""Inferring, enforcing and extending column types over the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import schema
from millrace.plans.registry import query, scratch_database, table, table_path
from millrace.sources import files, tables


def event_texts(spark, sf_dir):
    """The events with every column as text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("value").cast("string").alias("amount"),
        F.col("ts").cast("string").alias("moment"),
        F.col("ts").cast("date").cast("string").alias("day"),
        (F.col("event_type") == "error").cast("string").alias("failed"),
        F.col("props").alias("extra"),
        F.lit(None).cast("string").alias("nothing"),
    )


_EVENT_TEXTS = """SELECT CAST(event_id AS VARCHAR) AS id, CAST(value AS VARCHAR) AS amount, CAST(ts AS VARCHAR) AS moment,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(event_type = 'error' AS VARCHAR) AS failed, props AS extra,
    CAST(NULL AS VARCHAR) AS nothing FROM events"""


def _inferred(name: str) -> str:
    return f"""SELECT '{name}' AS column_name, CASE WHEN count({name}) = 0 THEN 'null'
        WHEN bool_and(regexp_full_match({name}, '[+-]?[0-9]+')) THEN 'int'
        WHEN bool_and(TRY_CAST({name} AS DOUBLE) IS NOT NULL) THEN 'float'
        WHEN bool_and(regexp_full_match({name}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST({name} AS DATE) IS NOT NULL) THEN 'date'
        WHEN bool_and(TRY_CAST({name} AS TIMESTAMP) IS NOT NULL) THEN 'datetime'
        WHEN bool_and(lower({name}) IN ('true', 'false')) THEN 'bool' ELSE 'str' END AS type FROM texts"""


@query(
    "sch_03_infer_types",
    f"WITH texts AS ({_EVENT_TEXTS}) "
    + " UNION ALL ".join(_inferred(n) for n in ("id", "amount", "moment", "day", "failed", "extra", "nothing")),
)
def infer_types(spark, sf_dir):
    return schema.infer_types(event_texts(spark, sf_dir))


@query(
    "sch_03_infer_json",
    """SELECT CASE WHEN bool_and(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND len(json_keys(props)) = 1)
              THEN 'OBJECT<k: BIGINT>' END AS type FROM events""",
)
def infer_json(spark, sf_dir):
    return schema.infer_json_type(table(spark, sf_dir, "events"), "props")


@query(
    "sch_04_enforce_casts",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
              CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
)
def enforce_casts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    return schema.enforce(lines, {"l_orderkey": str, "l_quantity": "int", "l_shipdate": dt.date})


@query(
    "sch_05_enforce_functions",
    """SELECT p_partkey, upper(p_name) AS p_name, '<' || p_brand || '>' AS p_brand, CAST(p_size * 2 AS BIGINT) AS p_size FROM part""",
)
def enforce_functions(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    rules = {
        "p_name": F.upper,
        "p_brand": schema.per_element(lambda value: f"<{value}>", str),
        "p_size": schema.per_batch(lambda values: values * 2, int),
    }
    return schema.enforce(part, rules)


@query(
    "sch_06_enforce_value_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def enforce_value_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return schema.enforce(orders, {"o_orderstatus": {"F": "final", "O": "open"}})


@query(
    "sch_07_fallback",
    "SELECT event_id AS id, value AS amount, props AS extra FROM events",
)
def fallback(spark, sf_dir):
    texts = event_texts(spark, sf_dir).select("id", "amount", "extra")
    return schema.enforce(texts, {"id": [int, float], "amount": [int, float], "extra": [int, float, str]})


@query(
    "sch_08_read_schema",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(trunc(s_acctbal) AS BIGINT) AS s_acctbal FROM supplier""",
)
def read_schema(spark, sf_dir):
    return files.read_files(
        spark, table_path(sf_dir, "supplier"), ["s_suppkey", "s_acctbal"],
        schema={"s_suppkey": "STRING", "s_acctbal": "INTEGER"},
    )


@query(
    "sch_09_add_missing",
    "SELECT c_custkey, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS score FROM customer",
)
def add_missing(spark, sf_dir):
    return schema.enforce(table(spark, sf_dir, "customer").select("c_custkey"), {"note": str, "score": float})


@query(
    "sch_10_merge_and_ignore",
    "SELECT CAST(event_id AS DOUBLE) AS id, value AS amount, props AS extra FROM events",
)
def merge_and_ignore(spark, sf_dir):
    texts = event_texts(spark, sf_dir).select("id", "amount", "extra")
    stored = {"id": "int64", "amount": "double", "extra": "int64"}
    return schema.enforce(texts, {"id": float}, dtypes=stored, errors="ignore")


@query(
    "sch_11_best_types",
    """SELECT event_id AS id, value AS amount, ts AS moment, CAST(ts AS DATE) AS day, event_type = 'error' AS failed, props AS extra FROM events""",
)
def best_types(spark, sf_dir):
    return schema.best_types(event_texts(spark, sf_dir).drop("nothing"))


@query(
    "sch_13_evolve",
    """SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal < 0.0
       UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal >= 0.0""",
)
def evolve(spark, sf_dir):
    customer, name = table(spark, sf_dir, "customer"), f"{scratch_database(spark)}.customer"
    tables.write_table(customer.where("c_acctbal < 0.0").select("c_custkey", "c_name"), name)
    tables.add_columns(spark, name, {"c_custkey": int, "c_name": str, "c_mktsegment": str})
    tables.insert(customer.where("c_acctbal >= 0.0").select("c_custkey", "c_name", "c_mktsegment"), name)
    return tables.read_table(spark, name)
