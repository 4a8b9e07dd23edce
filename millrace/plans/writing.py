"""Sinks and table operations: what was written is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.text import JSON_OPTIONS
from millrace.operators import documents, relation
from millrace.plans.registry import query, scratch_database, table
from millrace.session import scratch_path
from millrace.sources import changes, files, sinks, snapshots, tables
from millrace.sources.layout import RangePartition

_ORDERS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "snk_01_append",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL""",
)
def append(spark, sf_dir):
    orders, name = table(spark, sf_dir, "orders"), f"{scratch_database(spark)}.orders"
    tables.write_table(orders.where("o_orderstatus = 'F'").select(_ORDERS), name, "fail")
    tables.insert(orders.where("o_orderstatus <> 'F' OR o_orderstatus IS NULL").select("o_totalprice", "o_orderkey"), name)
    return tables.read_table(spark, name)


@query("snk_02_create_or_append", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def create_or_append(spark, sf_dir):
    supplier, name = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), f"{scratch_database(spark)}.supplier"
    tables.write_table(supplier, name)
    tables.write_table(supplier, name)
    return tables.read_table(spark, name)


@query("snk_03_replace", "SELECT p_partkey, p_brand FROM part")
def replace(spark, sf_dir):
    part, name = table(spark, sf_dir, "part"), f"{scratch_database(spark)}.part"
    tables.write_table(part.select("p_partkey", "p_size"), name, "replace")
    tables.write_table(part.select("p_partkey", "p_brand"), name, "replace")
    return tables.read_table(spark, name)


@query(
    "snk_04_create_from_schema",
    "SELECT c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal, CAST(NULL AS BOOLEAN) AS active FROM customer",
)
def create_from_schema(spark, sf_dir):
    name = f"{scratch_database(spark)}.customer"
    schema = {"c_custkey": "INTEGER", "c_name": "STRING", "c_acctbal": "STRING", "active": "BOOLEAN"}
    rows = table(spark, sf_dir, "customer").select("c_name", "c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"))
    tables.create_table(spark, name, schema, rows)
    return tables.read_table(spark, name)


@query(
    "snk_05_time_partition",
    """SELECT event_id, ts, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-08 06:00:00' AND ts < TIMESTAMP '2024-01-15 18:00:00'""",
)
def time_partition(spark, sf_dir):
    name = f"{scratch_database(spark)}.events"
    tables.write_table(table(spark, sf_dir, "events").select("event_id", "ts", "value"), name, time_partition="ts")
    filters = [("ts", ">=", dt.datetime(2024, 1, 8, 6)), ("ts", "<", dt.datetime(2024, 1, 15, 18))]
    return tables.read_table(spark, name, filters=filters)


@query("snk_06_range_partition", "SELECT c_custkey, c_name FROM customer WHERE c_custkey >= 333")
def range_partition(spark, sf_dir):
    name = f"{scratch_database(spark)}.customer"
    ranges = RangePartition("c_custkey", 0, 1000, 250)
    tables.write_table(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), name, range_partition=ranges)
    return tables.read_table(spark, name, filters=[("c_custkey", ">=", 333)])


@query(
    "snk_07_cluster",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey >= 100 AND o_custkey <= 400",
)
def cluster(spark, sf_dir):
    name = f"{scratch_database(spark)}.orders"
    tables.write_table(table(spark, sf_dir, "orders").select(_ORDERS), name, cluster_by=["o_custkey"])
    return tables.read_table(spark, name, filters=[("o_custkey", ">=", 100), ("o_custkey", "<=", 400)])


@query("snk_08_parquet_write", "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def parquet_write(spark, sf_dir):
    path = scratch_path(spark, "part.parquet")
    sinks.write_parquet(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), path, schema={"p_size": int})
    return files.read_parquet(spark, path)


@query(
    "snk_09_partitioned_write",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
)
def partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "lineitem.parquet")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    sinks.write_parquet(rows, path, partition_by=["l_returnflag", "l_linestatus"])
    return files.read_parquet(spark, path)


@query("snk_09_partitioned_by_all", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def partitioned_by_all(spark, sf_dir):
    path = scratch_path(spark, "days.parquet")
    rows = table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sinks.write_parquet(rows, path, partition_by=["event_type", "day"])
    return files.read_parquet(spark, path, schema={"event_type": str, "day": str, "__index": int})


@query("snk_10_document_write", "SELECT conv_id, turn, text FROM conversations")
def document_write(spark, sf_dir):
    path = scratch_path(spark, "conversations.json")
    documents.write_documents(
        table(spark, sf_dir, "conversations"), path, by="conv_id", order_by="turn", columns=["turn", "text"]
    )
    stored = files.open_files(spark, path, schema={"conv_id": int, "chunk": int, "document": str})
    return documents.unpack_documents(stored).select("conv_id", "turn", "text")


@query("snk_11_copy_table", "SELECT event_id, value, event_type FROM events")
def copy_table(spark, sf_dir):
    database, copies = scratch_database(spark), scratch_database(spark)
    rows = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    tables.write_table(rows, f"{database}.events", partition_by="event_type")
    tables.copy_table(spark, f"{database}.events", f"{copies}.events")
    return tables.read_table(spark, f"{copies}.events")


@query(
    "snk_12_copy_database",
    """SELECT 'customer' AS source, c_custkey AS id, c_name AS name FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""",
)
def copy_database(spark, sf_dir):
    database, copies = scratch_database(spark), scratch_database(spark)
    tables.write_table(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), f"{database}.customer")
    tables.write_table(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), f"{database}.supplier")
    names = tables.copy_database(spark, database, copies)
    return relation.concat(
        [tables.read_table(spark, f"{copies}.{n}").select(F.lit(n).alias("source"), "id", "name") for n in names]
    )


@query("snk_13_publish", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def publish(spark, sf_dir):
    path = scratch_path(spark, "topic")
    events = table(spark, sf_dir, "events")
    sinks.publish(events, path)
    return spark.read.text(path).select(F.from_json("value", events.schema, JSON_OPTIONS).alias("m")).select("m.*")


@query("snk_14_write_texts", "SELECT props AS value FROM events")
def write_texts(spark, sf_dir):
    path = scratch_path(spark, "texts")
    sinks.write_texts(table(spark, sf_dir, "events"), path, "props")
    return spark.read.text(path)


def _orders_table(spark, sf_dir):
    """All orders in a table whose files hold ranges of keys."""
    name = f"{scratch_database(spark)}.orders"
    rows = table(spark, sf_dir, "orders").select(*_ORDERS, "o_orderstatus", "o_orderpriority")
    tables.write_table(rows, name, cluster_by=["o_orderkey"])
    return name


@query("sql_01_delete", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000.0)")
def delete(spark, sf_dir):
    name = _orders_table(spark, sf_dir)
    changes.delete_rows(spark, name, {"o_orderstatus": "F"}, "o_totalprice > 100000.0")
    return tables.read_table(spark, name, _ORDERS)


@query(
    "sql_01_update",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -o_custkey ELSE o_custkey END AS o_custkey,
              CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def update(spark, sf_dir):
    name = _orders_table(spark, sf_dir)
    changes.update_rows(spark, name, {"o_custkey": -F.col("o_custkey"), "o_orderstatus": "X"}, {"o_orderpriority": "1-URGENT"})
    return tables.read_table(spark, name, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(
    "sql_01_merge",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal
       FROM customer WHERE c_acctbal >= 0 OR c_mktsegment = 'BUILDING'""",
)
def merge(spark, sf_dir):
    customer, name = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), f"{scratch_database(spark)}.customer"
    tables.write_table(customer.where("c_acctbal >= 0").drop("c_mktsegment"), name)
    builders = customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", (F.col("c_acctbal") * 2).alias("c_acctbal"))
    changes.merge_rows(builders, name, "c_custkey")
    return tables.read_table(spark, name)


@query("snk_11_snapshot", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders")
def snapshot(spark, sf_dir):
    name = _orders_table(spark, sf_dir)
    snapshots.take_snapshot(spark, name, "before")
    changes.delete_rows(spark, name, {"o_orderstatus": "F"})
    changes.update_rows(spark, name, {"o_totalprice": 0.0}, condition="o_custkey < 500")
    return snapshots.read_snapshot(spark, name, "before")


@query("snk_09_named_files", "SELECT n_regionkey, n_nationkey, n_name, '0.parquet' AS file FROM nation")
def named_files(spark, sf_dir):
    path = scratch_path(spark, "nation.parquet")
    sinks.write_parquet(table(spark, sf_dir, "nation").coalesce(1), path, partition_by=["n_regionkey"], basename="{i}.parquet")
    named = files.open_files(spark, path).select("*", F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("file"))
    return named.select("n_regionkey", "n_nationkey", "n_name", "file")
