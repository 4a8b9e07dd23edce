"""Sources: tables, files, partitions, objects, documents, entities, logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.names import last_segment
from millrace.functions.text import json_payload
from millrace.operators import documents, logs, relation
from millrace.plans.registry import query, scratch_database, table, table_path
from millrace.session import scratch_path
from millrace.sources import files, sinks, tables

_NOW = dt.datetime(2024, 1, 20, 12, 0, 0)


@query(
    "src_01_table_read",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value FROM events
       WHERE event_type IN ('error', 'click') AND value >= 20.0""",
)
def table_read(spark, sf_dir):
    name = f"{scratch_database(spark)}.events"
    tables.create_external(spark, name, table_path(sf_dir, "events"))
    return tables.read_table(
        spark, name, columns=["event_id", "user_id", "event_type", "value"],
        filters=[{"event_type": ["error", "click"]}, ("value", ">=", 20.0)], schema={"user_id": str},
    )


@query(
    "src_02_file_read",
    """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
       WHERE o_totalprice > 100000.0 AND o_orderdate >= TIMESTAMP '1996-01-01'""",
)
def file_read(spark, sf_dir):
    return files.read_files(
        spark, table_path(sf_dir, "orders"), columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        filters=[("o_totalprice", ">", 100000.0), ("o_orderdate", ">=", dt.datetime(1996, 1, 1))],
        schema={"o_orderdate": dt.date},
    )


@query("src_03_external_table", "SELECT c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM customer")
def external_table(spark, sf_dir):
    path = scratch_path(spark, "customer.json")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.json(path)
    name = f"{scratch_database(spark)}.customer"
    return tables.create_external(spark, name, path, {"c_custkey": int, "c_name": str, "c_acctbal": str})


@query(
    "src_04_format_inference",
    """SELECT fmt, p_partkey, p_name, p_size, p_retailprice
       FROM part, (VALUES ('parquet'), ('csv'), ('json'), ('orc')) AS f(fmt)""",
)
def format_inference(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    schema = {"p_partkey": int, "p_size": "int", "p_retailprice": float}
    reads = []
    for fmt in ("parquet", "csv", "json", "orc"):
        path = scratch_path(spark, f"part.{fmt}")
        part.write.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(path)
        read = files.read_files(spark, path, schema=schema)
        reads.append(read.select(F.lit(fmt).alias("fmt"), *part.columns))
    return relation.concat(reads).withColumn("p_size", F.col("p_size").cast("int"))


@query(
    "src_05_partitions_as_strings",
    """SELECT event_id, value, strftime(ts, '%d') AS day_code FROM events
       WHERE strftime(ts, '%d') IN ('03', '07', '21')""",
)
def partitions_as_strings(spark, sf_dir):
    path = scratch_path(spark, "events_by_day.parquet")
    days = table(spark, sf_dir, "events").select("event_id", "value", F.date_format("ts", "dd").alias("day_code"))
    sinks.write_parquet(days, path, partition_by="day_code")
    return files.read_external(spark, path, filters=[{"day_code": ["03", "07", "21"]}])


@query(
    "src_06_parquet_read",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
       WHERE (l_returnflag = 'R' AND l_quantity > 30.0) OR (l_returnflag != 'R' AND l_linestatus NOT IN ('O'))""",
)
def parquet_read(spark, sf_dir):
    found = files.read_parquet(
        spark, table_path(sf_dir, "lineitem"), columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
        filters=[
            [("l_returnflag", "=", "R"), ("l_quantity", ">", 30.0)],
            [("l_returnflag", "!=", "R"), ("l_linestatus", "not in", ["O"])],
        ],
    )
    absent = files.read_parquet(spark, scratch_path(spark, "absent.parquet"), schema=found.schema)
    return relation.concat([found, absent])


@query("src_07_partition_values", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def partition_values(spark, sf_dir):
    path = scratch_path(spark, "orders.parquet")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.write_parquet(orders, path, partition_by=["o_orderpriority", "o_orderstatus"])
    return files.read_partition_values(spark, path, {"o_orderpriority": str, "o_orderstatus": str})


@query("src_07_catalog_partitions", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def catalog_partitions(spark, sf_dir):
    name = f"{scratch_database(spark)}.lineitem"
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    tables.write_table(rows, name, partition_by=["l_returnflag", "l_linestatus"])
    return tables.table_partitions(spark, name)


@query("src_08_read_objects", "SELECT item_id, text FROM benchmark")
def read_objects(spark, sf_dir):
    path = scratch_path(spark, "objects")
    sinks.write_texts(table(spark, sf_dir, "benchmark"), path, "text", one_object_per="item_id")
    texts = files.read_texts(spark, path)
    # The text sink ends each row with a newline.
    return texts.select(F.col("item_id").cast("bigint").alias("item_id"), F.regexp_replace("text", "\n\\z", "").alias("text"))


@query(
    "src_09_collection_read",
    "SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_name, c_acctbal FROM customer",
)
def collection_read(spark, sf_dir):
    path = scratch_path(spark, "store.json")
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    key = F.col("c_custkey").cast("string")
    owners = customer.select(F.concat(F.lit("customers/"), key).alias("path"), json_payload("c_name", "c_acctbal").alias("data"))
    children = orders.select(
        F.format_string("customers/%d/orders/%d", "o_custkey", "o_orderkey").alias("path"),
        json_payload("o_totalprice").alias("data"),
    )
    owners.unionByName(children).write.json(path)
    stored = files.open_files(spark, path, schema={"path": str, "data": str})
    members = documents.collection(stored, "path", "customers")
    return members.select("doc_id", F.from_json("data", "c_name string, c_acctbal double").alias("d")).select("doc_id", "d.*")


@query(
    "src_10_entity_fetch",
    "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3",
)
def entity_fetch(spark, sf_dir):
    return relation.fetch(
        table(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING", "c_nationkey": 3}, order_by="-c_acctbal"
    )


def log_entries(spark, sf_dir):
    """The events as log entries."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("severity"), F.col("props").alias("message")
    )


@query(
    "src_11_log_search",
    """SELECT event_id, ts AS timestamp, event_type AS severity, props AS message,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' UTC' AS timestamp_str, props AS message_str,
              'LogEntry - [' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' UTC] ' || props AS line
       FROM events WHERE event_type = 'error' AND user_id IS NOT NULL
         AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-19 12:00:00'""",
)
def log_search(spark, sf_dir):
    found = logs.search_logs(
        log_entries(spark, sf_dir), query="event_id is not null", severity="error",
        time_start=dt.datetime(2024, 1, 5), time_end=dt.datetime(2024, 1, 19, 12),
    )
    return logs.with_entry_text(found)


@query(
    "src_12_file_inventory",
    """SELECT name || '.parquet' AS name, true AS has_bytes FROM (VALUES ('benchmark'), ('conversations'), ('customer'), ('documents'),
       ('embeddings'), ('events'), ('labels'), ('lineitem'), ('nation'), ('orders'), ('pages'), ('part'), ('region'), ('supplier')) AS t(name)""",
)
def file_inventory(spark, sf_dir):
    found = files.file_inventory(spark, sf_dir, "*.parquet")
    return found.select(last_segment(F.col("path")).alias("name"), (F.col("length") > 0).alias("has_bytes"))


@query(
    "src_12_folder_listing",
    "SELECT DISTINCT 'event_type=' || event_type AS name, true AS is_dir, true AS has_bytes FROM events",
)
def folder_listing(spark, sf_dir):
    path = scratch_path(spark, "events.parquet")
    sinks.write_parquet(table(spark, sf_dir, "events").drop("props"), path, partition_by="event_type")
    listed = files.list_folder(files.file_inventory(spark, path, "*.parquet"), path)
    return listed.select("name", "is_dir", (F.col("num_bytes") > 0).alias("has_bytes"))


@query(
    "src_13_ingest",
    """SELECT c_custkey, c_mktsegment, label, CAST(weight AS DOUBLE) AS weight FROM customer
       LEFT JOIN (VALUES ('BUILDING', 'b', 1.5), ('MACHINERY', 'm', 2.0), ('HOUSEHOLD', 'h', NULL)) AS s(seg, label, weight)
       ON c_mktsegment = seg""",
)
def ingest(spark, sf_dir):
    segments = files.ingest_rows(
        spark, {"c_mktsegment": ["BUILDING", "MACHINERY", "HOUSEHOLD"], "label": ["b", "m", "h"], "weight": [1.5, 2.0, None]}
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customer.join(segments, "c_mktsegment", "left").select("c_custkey", "c_mktsegment", "label", "weight")


@query("prj_01_columns", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def columns(spark, sf_dir):
    return relation.project(table(spark, sf_dir, "lineitem"), ["*", "l_orderkey", "l_partkey", "l_extendedprice"])


@query("prj_01_all_columns", "SELECT * FROM supplier")
def all_columns(spark, sf_dir):
    return relation.project(table(spark, sf_dir, "supplier"), "*")


def _events_by_day(spark, sf_dir):
    path = scratch_path(spark, "events.parquet")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sinks.write_parquet(events, path, partition_by=["event_type", "day"])
    return files.walk_folders(files.file_inventory(spark, path, "*.parquet"), path)


@query(
    "src_12_walk",
    """WITH e AS (SELECT DISTINCT event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)
       SELECT '' AS path, '' AS name, 0 AS depth, true AS has_files UNION ALL
       SELECT DISTINCT 'event_type=' || event_type, 'event_type=' || event_type, 1, true FROM e UNION ALL
       SELECT 'event_type=' || event_type || '/day=' || day, 'day=' || day, 2, true FROM e""",
)
def walk(spark, sf_dir):
    return _events_by_day(spark, sf_dir).where("is_dir").select("path", "name", "depth", (F.col("num_files") > 0).alias("has_files"))


@query(
    "src_12_glob",
    """SELECT DISTINCT 'event_type=' || event_type || '/day=' || strftime(ts, '%Y-%m-%d') AS folder FROM events
       WHERE event_type LIKE '%r%' AND strftime(ts, '%d') LIKE '1_'""",
)
def glob(spark, sf_dir):
    found = files.glob_paths(_events_by_day(spark, sf_dir).where("NOT is_dir"), "event_type=*r*/**/day=2024-01-1?/*.parquet")
    return found.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
