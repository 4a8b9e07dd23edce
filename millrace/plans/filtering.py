"""Predicates, limits, order and newest rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import predicates
from millrace.operators import logs, relation
from millrace.plans.reading import log_entries
from millrace.plans.registry import query, table


@query(
    "flt_01_comparisons",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10.0 AND l_quantity < 40.0
       AND l_discount > 0.02 AND l_tax <= 0.06 AND l_returnflag = 'A'""",
)
def comparisons(spark, sf_dir):
    filters = [
        ("l_quantity", ">=", 10.0), ("l_quantity", "<", 40.0), ("l_discount", ">", 0.02),
        ("l_tax", "<=", 0.06), ("l_returnflag", "=", "A"),
    ]
    return predicates.where(table(spark, sf_dir, "lineitem"), filters).select("l_orderkey", "l_linenumber", "l_quantity")


@query("flt_02_in_list", "SELECT * FROM part WHERE p_size IN (1, 5, 9, 25) AND p_brand IN ('Brand#2', 'Brand#17')")
def in_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    some = predicates.where(part, [("p_size", "IN", [1, 5, 9, 25]), ("p_brand", "in", ["Brand#2", "Brand#17"])])
    none = predicates.where(part, [("p_size", "IN", [])])
    return some.unionByName(none)


@query("flt_03_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%widget%' AND p_brand LIKE 'Brand#1_'")
def like(spark, sf_dir):
    filters = [("p_name", "like", "%widget%"), ("p_brand", "LIKE", "Brand#1_")]
    return predicates.where(table(spark, sf_dir, "part"), filters).select("p_partkey", "p_name")


@query(
    "flt_04_dict_shorthand",
    """SELECT event_id, user_id FROM events WHERE event_type IN ('error', 'view') AND user_id IN (7) AND value > 5.0""",
)
def dict_shorthand(spark, sf_dir):
    filters = [{"event_type": ["error", "view"], "user_id": 7}, ("value", ">", 5.0)]
    return predicates.where(table(spark, sf_dir, "events"), filters).select("event_id", "user_id")


@query(
    "flt_05_conjunction",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000.0
       AND o_orderdate < TIMESTAMP '1998-06-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
       UNION ALL SELECT o_orderkey FROM orders""",
)
def conjunction(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    filters = [
        ("o_orderstatus", "=", "F"), ("o_totalprice", ">", 50000.0), ("o_orderdate", "<", dt.datetime(1998, 6, 1)),
        {"o_orderpriority": ["1-URGENT", "2-HIGH"]},
    ]
    return predicates.where(orders, filters).unionByName(predicates.where(orders, [])).select("o_orderkey")


@query(
    "flt_06_checked_operators",
    "SELECT c_custkey FROM customer WHERE c_name LIKE '%--%' OR c_mktsegment = 'MACHINERY'",
)
def checked_operators(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    # Values are literals, so text such as "--" is data.
    groups = [[("c_name", "like", "%--%")], [("c_mktsegment", "=", "MACHINERY")]]
    return customer.where(predicates.disjunction(customer.schema, groups, predicates.TABLE_OPERATORS)).select("c_custkey")


@query("flt_07_equality_map", "SELECT * FROM supplier WHERE s_nationkey = 20 AND s_name <> ''")
def equality_map(spark, sf_dir):
    return predicates.where_equal(table(spark, sf_dir, "supplier"), {"s_nationkey": 20})


@query(
    "flt_08_or_of_ands",
    """SELECT p_partkey FROM part WHERE (p_size < 5 AND p_type = 'ECONOMY') OR (p_size > 45 AND p_brand != 'Brand#2')
       OR p_type NOT IN ('ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'MEDIUM')""",
)
def or_of_ands(spark, sf_dir):
    groups = [
        [("p_size", "<", 5), ("p_type", "==", "ECONOMY")],
        [("p_size", ">", 45), ("p_brand", "!=", "Brand#2")],
        [("p_type", "not in", ["ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM"])],
    ]
    return predicates.where_file(table(spark, sf_dir, "part"), groups).select("p_partkey")


@query(
    "flt_09_membership",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 3) AND l_returnflag IN ('N')",
)
def membership(spark, sf_dir):
    filters = predicates.membership({"l_linenumber": [1, 3], "l_returnflag": "N"})
    return predicates.where_file(table(spark, sf_dir, "lineitem"), filters).select("l_orderkey", "l_linenumber")


@query(
    "flt_10_log_predicates",
    """SELECT event_id FROM events WHERE event_type = 'purchase' AND props LIKE '%7%'
       AND ts >= TIMESTAMP '2024-01-18 12:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def log_predicates(spark, sf_dir):
    found = logs.search_logs(
        log_entries(spark, sf_dir), query="message like '%7%'", severity="purchase", time_range=48,
        now=dt.datetime(2024, 1, 20, 12),
    )
    return found.select("event_id")


@query(
    "flt_11_any_prefix",
    "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red') OR starts_with(p_name, 'small') OR starts_with(p_name, 'test_')",
)
def any_prefix(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.where(predicates.starts_with_any(F.col("p_name"), ["red", "small", "test_"]))


@query(
    "flt_12_all_elements",
    "SELECT doc_id FROM documents WHERE len(list_filter(string_split(text, ' '), lambda w: length(w) > 24)) = 0",
)
def all_elements(spark, sf_dir):
    words = F.split("text", " ")
    docs = table(spark, sf_dir, "documents")
    return docs.where(predicates.every(words, lambda word: F.length(word) <= 24)).select("doc_id")


@query("flt_12_all_rows", "SELECT l_orderkey, bool_and(l_quantity > 10.0) AS passes FROM lineitem GROUP BY l_orderkey")
def all_rows(spark, sf_dir):
    return relation.all_rows_pass(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_quantity") > 10.0)


@query("flt_13_state", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def state(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(predicates.in_state(F.col("o_orderstatus"), "F")).select("o_orderkey")


@query("lim_01_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 250")
def limit(spark, sf_dir):
    ordered = relation.order_rows(table(spark, sf_dir, "orders"), "o_orderkey")
    return relation.limit_rows(relation.limit_rows(relation.limit_rows(ordered, 250), 0), None)


@query("lim_02_default_cap", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def default_cap(spark, sf_dir):
    entries = log_entries(spark, sf_dir)
    return logs.search_logs(entries, order_by=["timestamp desc", "event_id desc"]).select("event_id")


@query("srt_01_order", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def order(spark, sf_dir):
    return relation.order_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"])


@query("srt_02_newest_first", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 300")
def newest_first(spark, sf_dir):
    return relation.newest_first(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "event_id", 300)


@query("top_01_first", "SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def first(spark, sf_dir):
    return relation.fetch_one(table(spark, sf_dir, "customer"), {"c_mktsegment": "MACHINERY"}, ["-c_acctbal", "c_custkey"])


_RANKED = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM events"


@query("top_02_keep_newest", f"SELECT * EXCLUDE (rk) FROM ({_RANKED}) WHERE rk <= 2")
def keep_newest(spark, sf_dir):
    return relation.keep_newest(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", 2)


@query("top_02_drop_newest", f"SELECT * EXCLUDE (rk) FROM ({_RANKED}) WHERE rk > 2")
def drop_newest(spark, sf_dir):
    return relation.drop_newest(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", 2)
