"""Scalar functions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import names, text
from millrace.functions.casts import cast_or_null
from millrace.plans.registry import query, table


@query(
    "fn_01_shorten_name",
    """SELECT c_custkey, 'p' || c_nationkey || '/eu/' || c_mktsegment || '/' || c_custkey AS short,
              c_mktsegment || '/' || c_custkey AS path FROM customer""",
)
def shorten_name(spark, sf_dir):
    full = F.format_string("projects/p%d/locations/eu/lakes/%s/zones/%d", "c_nationkey", "c_mktsegment", "c_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", full.alias("full"))
    return customer.select("c_custkey", names.shorten(F.col("full")).alias("short"), names.shorten(F.col("full"), 2).alias("path"))


@query("fn_02_last_segment", "SELECT page_id, list_last(string_split(url, '/')) AS last FROM pages")
def last_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", names.last_segment(F.col("url")).alias("last"))


@query(
    "fn_03_table_id",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'proj' END AS project,
              CASE WHEN o_orderstatus IN ('F', 'O') THEN 'd' || o_custkey END AS dataset, 't' || o_orderkey AS "table" FROM orders""",
)
def table_id(spark, sf_dir):
    status = F.col("o_orderstatus")
    identifier = (
        F.when(status == "F", F.format_string("proj.d%d.t%d", "o_custkey", "o_orderkey"))
        .when(status == "O", F.format_string("d%d.t%d", "o_custkey", "o_orderkey"))
        .otherwise(F.format_string("t%d", "o_orderkey"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", names.table_id_parts(identifier).alias("id"))
    return orders.select("o_orderkey", "id.*")


@query("fn_04_url_decode", "SELECT p_partkey, p_name || '/' || p_brand || '+' AS decoded FROM part")
def url_decode(spark, sf_dir):
    encoded = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit("%2F"), F.replace("p_brand", F.lit("#"), F.lit("%23")), F.lit("+")
    )
    return table(spark, sf_dir, "part").select("p_partkey", names.url_decode(encoded).alias("decoded"))


@query("fn_05_partition_map", "SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status FROM orders")
def partition_map(spark, sf_dir):
    encoded = F.replace("o_orderpriority", F.lit(" "), F.lit("%20"))
    path = F.concat(F.lit("/lake/orders/priority="), encoded, F.lit("/status="), F.col("o_orderstatus"), F.lit("/part-0.parquet"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", names.partition_values(path).alias("v"))
    return orders.select("o_orderkey", F.col("v")["priority"].alias("priority"), F.col("v")["status"].alias("status"))


@query("fn_06_underscores", "SELECT n_nationkey, replace(n_name, '_', ' ') AS name, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def underscores(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", text.underscores_to_spaces(F.col("n_name")).alias("name"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return customer.join(nation, "n_nationkey")


@query("fn_07_timestamp_label", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' UTC' AS label FROM events")
def timestamp_label(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.timestamp_label(F.col("ts")).alias("label"))


@query(
    "fn_08_message_text",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed ' || user_id ELSE props END AS message FROM events",
)
def message_text(spark, sf_dir):
    payload = F.when(
        F.col("event_type") == "error",
        text.json_payload(F.format_string("failed %d", "user_id").alias("message"), F.col("value")),
    ).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", text.message_text(payload).alias("message"))


@query(
    "fn_09_log_line",
    "SELECT event_id, 'LogEntry - [' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' UTC] ' || event_type AS line FROM events",
)
def log_line(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.log_line(F.col("ts"), F.col("event_type")).alias("line"))


@query(
    "fn_10_json_payload",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey, o_orderpriority AS priority,
              o_orderstatus <> 'P' AS has_status FROM orders""",
)
def json_payload(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status")
    payload = text.json_payload(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"), status)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("p"))
    return orders.select(
        "o_orderkey",
        F.get_json_object("p", "$.custkey").alias("custkey"),
        F.get_json_object("p", "$.priority").alias("priority"),
        # A NULL member stays in the text.
        (~F.col("p").contains('"status":null')).alias("has_status"),
    )


@query(
    "fn_11_value_map",
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE CAST(l_linenumber AS VARCHAR) END AS line,
              CASE l_returnflag WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag FROM lineitem""",
)
def value_map(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        text.map_values(F.col("l_linenumber"), {1: "one", 2: "two"}).alias("line"),
        text.map_values(F.col("l_returnflag"), {"R": "returned"}).alias("flag"),
    )


@query(
    "fn_12_status",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'Has not run yet' WHEN user_id % 4 = 0 THEN 'Success'
              WHEN user_id % 4 = 2 THEN 'Failed' ELSE CAST(user_id % 4 AS VARCHAR) END AS status,
              CASE WHEN value > 10.0 THEN 'Active' ELSE 'Inactive' END AS traffic FROM events""",
)
def status(spark, sf_dir):
    attempt = F.when(F.col("event_type") != "view", F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.attempt_status(attempt, F.col("user_id") % 4).alias("status"),
        text.traffic_status(F.col("value") - 10.0).alias("traffic"),
    )


@query(
    "fn_13_casts",
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_orderdate AS DATE) AS day,
              CAST(o_orderkey AS VARCHAR) AS key_text, TRY_CAST(o_orderstatus AS BIGINT) AS no_number FROM orders""",
)
def casts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("bigint").alias("whole"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        cast_or_null(F.col("o_orderstatus"), T.StringType(), T.LongType()).alias("no_number"),
    )
