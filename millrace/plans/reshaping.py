"""Columns to rows, nested JSON, maps and packed documents over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import documents, reshape
from millrace.plans.registry import query, table
from millrace.session import materialise

_CHUNK = 500


def _columns_by_type(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "value")
    return reshape.rows_to_columns(events, "event_type", "event_id", ["event_id", "user_id", "value"], _CHUNK)


@query("rsh_01_columns_to_rows", "SELECT event_type, event_id, user_id, value FROM events")
def columns_to_rows(spark, sf_dir):
    rows = reshape.columns_to_rows(_columns_by_type(spark, sf_dir), ["event_id", "user_id", "value"])
    return rows.select("event_type", "event_id", "user_id", "value")


@query(
    "rsh_02_rows_to_columns",
    f"""WITH n AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {_CHUNK} AS chunk FROM events)
        SELECT event_type, chunk, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS event_ids,
               string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY event_id) AS user_ids FROM n GROUP BY event_type, chunk""",
)
def rows_to_columns(spark, sf_dir):
    chunks = _columns_by_type(spark, sf_dir)
    return chunks.select(
        "event_type", "chunk",
        F.array_join(F.col("event_id").cast("array<string>"), ",").alias("event_ids"),
        F.array_join(F.col("user_id").cast("array<string>"), ",").alias("user_ids"),
    )


def nested_events(spark, sf_dir):
    """Each event as a nested JSON text, stored."""
    events = table(spark, sf_dir, "events")
    inner = F.struct(F.get_json_object("props", "$.k").cast("int").alias("e"))
    body = F.struct(
        F.col("event_id").alias("a"),
        F.struct(F.col("user_id").alias("c"), F.col("event_type").alias("t")).alias("b"),
        F.array(F.to_json(inner), F.col("event_id").cast("string")).alias("d"),
        inner.alias("f"),
    )
    return materialise(events.select("event_id", F.to_json(body).alias("doc")), "nested")


@query(
    "rsh_03_flatten_values",
    """WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
       SELECT event_id, '0' AS place, CAST(event_id AS VARCHAR) AS value FROM e
       UNION ALL SELECT event_id, '1,0', CAST(user_id AS VARCHAR) FROM e
       UNION ALL SELECT event_id, '1,1', event_type FROM e
       UNION ALL SELECT event_id, '2,0', '{"e":' || k || '}' FROM e
       UNION ALL SELECT event_id, '2,1', CAST(event_id AS VARCHAR) FROM e
       UNION ALL SELECT event_id, '3,0', k FROM e""",
)
def flatten_values(spark, sf_dir):
    leaves = reshape.flatten_values(nested_events(spark, sf_dir), "doc", ["event_id"])
    return leaves.withColumn("place", F.array_join(F.col("place").cast("array<string>"), ","))


@query(
    "rsh_04_flatten_keys",
    "SELECT event_id, unnest(['a', 'b', 'c', 't', 'd', 'f', 'e']) AS key FROM events",
)
def flatten_keys(spark, sf_dir):
    return reshape.flatten_keys(nested_events(spark, sf_dir), "doc", ["event_id"]).select("event_id", "key")


@query(
    "rsh_05_invert_map",
    "SELECT o_orderkey, CASE WHEN o_orderkey <> o_custkey THEN 'order' ELSE 'customer' END AS order_name, 'customer' AS customer_name FROM orders",
)
def invert_map(spark, sf_dir):
    pairs = F.create_map(F.lit("order"), F.col("o_orderkey"), F.lit("customer"), F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", reshape.invert_map(pairs).alias("m"))
    return orders.select(
        "o_orderkey", F.col("m")[F.col("o_orderkey")].alias("order_name"), F.col("m")[F.col("o_custkey")].alias("customer_name")
    )


@query("rsh_05_invert_pairs", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def invert_pairs(spark, sf_dir):
    return reshape.invert_pairs(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", ["o_orderdate", "o_orderkey"])


@query("rsh_06_wrap_scalars", "SELECT c_custkey, 1 AS n, c_name AS only FROM customer")
def wrap_scalars(spark, sf_dir):
    wrapped = reshape.wrap_scalars(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("only")), ["only"])
    again = reshape.wrap_scalars(wrapped, ["only"])
    return again.select("c_custkey", F.size("only").alias("n"), F.col("only")[0].alias("only"))


@query(
    "rsh_07_pack",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations)
       SELECT conv_id, CAST(0 AS BIGINT) AS chunk, count(*) AS n_rows, max(CASE WHEN i = 1 THEN role END) AS first_role,
              max(CASE WHEN i = 2 THEN text END) AS second_text, 'int64' AS turn_dtype, 'object' AS text_dtype
       FROM n GROUP BY conv_id""",
)
def pack(spark, sf_dir):
    packed = documents.pack_documents(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    member = lambda path: F.get_json_object("document", path)
    return packed.select(
        "conv_id", "chunk",
        F.size(F.json_object_keys(member("$.data.turn"))).cast("bigint").alias("n_rows"),
        member("$.data.role.0").alias("first_role"),
        member("$.data.text.1").alias("second_text"),
        member("$.metadata.dtypes.turn").alias("turn_dtype"),
        member("$.metadata.dtypes.text").alias("text_dtype"),
    )


@query("rsh_08_unpack", "SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_orderdate FROM orders")
def unpack(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_orderpriority")
    packed = materialise(documents.pack_documents(orders, "o_custkey", "o_orderkey", chunk_rows=4), "packed")
    return documents.unpack_documents(packed).drop("chunk")


@query(
    "rsh_09_document_schema",
    """SELECT n_regionkey, n_nationkey, CASE WHEN n_regionkey = 1 THEN trunc(c_acctbal) ELSE c_acctbal END AS balance, c_custkey
       FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def document_schema(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_acctbal").cast("string").alias("balance")
    )
    rows = customer.join(nation, "n_nationkey")
    packed = materialise(documents.pack_documents(rows, "n_regionkey", "c_custkey"), "packed")
    frame = documents.unpack_documents(packed).drop("chunk")
    numbers = frame.withColumn("balance", F.col("balance").cast("double"))
    return documents.cast_documents(numbers, "n_regionkey", {1: {"balance": int}, 2: {"balance": float}})


@query(
    "rsh_09_document_variant",
    """SELECT n_regionkey, n_nationkey, c_custkey,
              CASE n_regionkey WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'STRING' ELSE 'DOUBLE' END AS balance_type,
              CASE n_regionkey WHEN 1 THEN trunc(c_acctbal) ELSE c_acctbal END AS balance
       FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def document_variant(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_acctbal").alias("balance"))
    packed = materialise(documents.pack_documents(customer.join(nation, "n_nationkey"), "n_regionkey", "c_custkey"), "packed")
    frame = documents.unpack_documents(packed).drop("chunk")
    typed = documents.variant_types(documents.variant_documents(frame, "n_regionkey", {1: {"balance": int}, 2: {"balance": str}}), ["balance"])
    return typed.withColumn("balance", F.variant_get("balance", "$", "double"))
