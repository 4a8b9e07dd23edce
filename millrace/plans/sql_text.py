"""SQL text with parameters, and one acceptance query per class of SELECT."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import schema, sql
from millrace.plans.registry import query, table


def _run(spark, sf_dir, text, names, params=None, result_schema=None):
    return sql.query(spark, text, params, result_schema, **{name: table(spark, sf_dir, name) for name in names})


def _braced(text: str, names) -> str:
    """The oracle text with its table names as frame placeholders."""
    words = [f"{{{w}}}" if w in names else w for w in text.split(" ")]
    return " ".join(words)


# A hot key may hold a third of the rows, so the texts below reduce the many
# side of a join to one row per key before the join, where the result allows.
def acceptance(name: str, names: list[str], text: str, oracle: str | None = None):
    """Register SQL text over the named tables; the same text is the oracle unless one is given."""
    text = " ".join(text.split())

    @query(name, oracle or text)
    def run(spark, sf_dir):
        return _run(spark, sf_dir, _braced(text, names), names)

    return run


@query("sql_01_select", "SELECT * FROM orders WHERE o_orderstatus = 'P'")
def select(spark, sf_dir):
    return _run(spark, sf_dir, "SELECT * FROM {orders} WHERE o_orderstatus = 'P'", ["orders"])


@query(
    "sql_02_parameters",
    "SELECT event_id FROM events WHERE user_id > 20 AND value <= 9.5 AND event_type = 'click' AND ts >= TIMESTAMP '2024-01-12'",
)
def parameters(spark, sf_dir):
    text = """SELECT event_id FROM {events} WHERE user_id > :user AND value <= :most AND event_type = :kind
              AND ts >= :since"""
    params = {"user": 20, "most": 9.5, "kind": "click", "since": dt.datetime(2024, 1, 12)}
    return _run(spark, sf_dir, text, ["events"], params)


@query("sql_03_array_parameters", "SELECT event_id FROM events WHERE event_type IN ('error', 'view') AND user_id IN (1, 2, 3)")
def array_parameters(spark, sf_dir):
    text = "SELECT event_id FROM {events} WHERE array_contains(:kinds, event_type) AND array_contains(:users, user_id)"
    return _run(spark, sf_dir, text, ["events"], {"kinds": ["error", "view"], "users": [1, 2, 3]})


@query(
    "sql_04_typed_result",
    "SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY o_custkey",
)
def typed_result(spark, sf_dir):
    text = "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey"
    return _run(spark, sf_dir, text, ["orders"], result_schema={"o_custkey": str, "n": float})


acceptance(
    "sql_a_inner_joins", ["customer", "orders", "lineitem"],
    """SELECT c_mktsegment, o_orderpriority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
       count(*) AS n_lines FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY c_mktsegment, o_orderpriority""",
    """SELECT c_mktsegment, o_orderpriority, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
       count(*) AS n_lines FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
       GROUP BY c_mktsegment, o_orderpriority""",
)
acceptance(
    "sql_b_outer_join", ["customer", "orders"],
    """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN
       (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) o ON c_custkey = o_custkey""",
    """SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey
       AND o_orderstatus = 'F' GROUP BY c_custkey""",
)
acceptance(
    "sql_b_semi_join", ["customer", "orders"],
    """SELECT c_custkey FROM customer LEFT SEMI JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000.0) o
       ON c_custkey = o_custkey""",
    "SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000.0",
)
acceptance(
    "sql_b_anti_join", ["customer", "orders"],
    "SELECT c_custkey FROM customer LEFT ANTI JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000.0) o ON c_custkey = o_custkey",
    "SELECT c_custkey FROM customer ANTI JOIN (SELECT * FROM orders WHERE o_totalprice > 400000.0) o ON c_custkey = o_custkey",
)
acceptance(
    "sql_c_group_having", ["lineitem"],
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(*) AS n_lines, max(l_quantity) AS most
       FROM lineitem GROUP BY l_suppkey HAVING count(*) > 50""",
)
_SUM = "CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity"
acceptance(
    "sql_d_rollup", ["lineitem"],
    f"SELECT l_returnflag, l_linestatus, CAST(grouping(l_linestatus) AS INT) AS all_status, {_SUM} FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
)
acceptance(
    "sql_d_cube", ["lineitem"],
    f"SELECT l_returnflag, l_linestatus, {_SUM} FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
)
acceptance(
    "sql_d_grouping_sets", ["lineitem"],
    f"SELECT l_returnflag, l_linenumber, {_SUM} FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linenumber), ())",
)
# The rows are summed per month first, so the windows run over months and not over orders.
_MONTHS = """WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS month, count(*) AS n
    FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate))"""
acceptance(
    "sql_e_windows", ["orders"],
    f"""{_MONTHS} SELECT o_orderpriority, CAST(month AS DATE) AS month, n,
        CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, month) AS BIGINT) AS place,
        CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY n DESC) AS BIGINT) AS rnk,
        lag(n) OVER (PARTITION BY o_orderpriority ORDER BY month) AS before,
        CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS quarter FROM m""",
)
acceptance(
    "sql_f_union_all", ["customer", "supplier"],
    "SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey AS nationkey FROM supplier",
)
acceptance(
    "sql_f_intersect", ["orders", "customer"],
    "SELECT DISTINCT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey AS custkey FROM customer",
)
acceptance(
    "sql_f_except", ["orders", "customer"],
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT DISTINCT o_custkey AS custkey FROM orders",
)
acceptance(
    "sql_g_correlated", ["lineitem", "part"],
    """SELECT p_partkey, p_name FROM part WHERE EXISTS
       (SELECT 1 FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49.0) q WHERE q.l_partkey = p_partkey)
       AND p_retailprice > (SELECT avg(CAST(l_tax AS DECIMAL(18, 4))) FROM lineitem WHERE l_partkey = p_partkey)""",
)
acceptance(
    "sql_g_cte", ["orders"],
    """WITH totals AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey),
       big AS (SELECT o_custkey, total FROM totals WHERE total > 1000000.0)
       SELECT o_custkey, total, total = (SELECT max(total) FROM big ) AS is_best FROM big""",
)
acceptance(
    "sql_h_scalars", ["orders"],
    """SELECT o_orderkey, upper(o_orderpriority) AS priority, substring(o_orderpriority, 3) AS label, round(o_totalprice / 1000.0, 0) AS thousands,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(year(o_orderdate) AS BIGINT) AS year, abs(o_custkey - o_orderkey) AS gap,
       coalesce(nullif(o_orderstatus, 'P'), 'none') AS status FROM orders""",
)
acceptance(
    "sql_h_json_and_arrays", ["events"],
    """SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k, word FROM events
       LATERAL VIEW explode(split(event_type, 'r')) w AS word""",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, unnest(string_split(event_type, 'r')) AS word FROM events""",
)


@query("udf_01_user_function", "SELECT event_id, event_type || ':' || length(props) AS event_type FROM events")
def user_function(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws(":", "event_type", "props").alias("event_type")
    )

    def shortened(value: str) -> str:
        kind, _, props = value.partition(":")
        return f"{kind}:{len(props)}"

    return schema.enforce(events, {"event_type": schema.per_element(shortened, str)})
