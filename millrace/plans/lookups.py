"""Lookups, hierarchies, counts, row numbers and concatenation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dialects, lookup, numbering, relation, schema
from millrace.plans.registry import query, scratch_database, table
from millrace.sources import tables

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _versions(spark, sf_dir):
    """Tag, version and artifact tables: line items refer to orders, orders to customers."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("version"), F.col("l_linenumber").alias("tag"))
    versions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("artifact"))
    artifacts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("artifact"), F.col("c_name").alias("name"))
    return lines, versions, artifacts


_CHAIN = """SELECT l_linenumber AS tag, l_orderkey AS version, o_custkey AS artifact, c_name AS name
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""


@query("jn_01_resolve_chain", _CHAIN)
def resolve_chain(spark, sf_dir):
    lines, versions, artifacts = _versions(spark, sf_dir)
    return lookup.resolve_chain(lines, [(versions, "version"), (artifacts, "artifact")])


@query("jn_01_salted_lookup", _CHAIN)
def salted_lookup(spark, sf_dir):
    lines, versions, artifacts = _versions(spark, sf_dir)
    resolved = lookup.salted_join(versions, artifacts, "artifact", "left", min_rows=1)
    return lookup.salted_join(lines, resolved, "version", min_rows=1)


@query(
    "jn_01_missing_keys",
    "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def missing_keys(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return lookup.missing_keys(table(spark, sf_dir, "customer"), urgent, "c_custkey")


@query(
    "jn_02_pointing_at",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def pointing_at(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    targets = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup.pointing_at(lines, targets, "l_orderkey")


@query(
    "jn_03_hierarchy",
    """SELECT r_name, n_name, c_custkey, c_name FROM region
       JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey""",
)
def hierarchy(spark, sf_dir):
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = table(spark, sf_dir, "customer")
    expanded = lookup.expand_hierarchy(region, [(nation, "n_regionkey"), (customer, "c_nationkey")], right_is_small=True)  # regions and nations
    return expanded.select("r_name", "n_name", "c_custkey", "c_name")


@query(
    "jn_03_from_second_level",
    "SELECT n_name, s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey",
)
def from_second_level(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return lookup.expand_hierarchy(nation, [(table(spark, sf_dir, "supplier"), "s_nationkey")], right_is_small=True).select("n_name", "s_suppkey")


@query(
    "agg_01_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in _TABLES),
)
def row_counts(spark, sf_dir):
    return relation.concat([relation.row_count(table(spark, sf_dir, t), t) for t in _TABLES])


@query("agg_01_table_stats", "SELECT count(*) AS num_rows, true AS has_bytes FROM lineitem")
def table_stats(spark, sf_dir):
    name = f"{scratch_database(spark)}.lineitem"
    tables.write_table(table(spark, sf_dir, "lineitem"), name)
    return tables.table_stats(spark, name).select("num_rows", (F.col("num_bytes") > 0).alias("has_bytes"))


@query(
    "agg_02_first_values",
    """SELECT arg_min(user_id, event_id) FILTER (WHERE event_type = 'purchase') AS buyer,
              arg_min(value, event_id) FILTER (WHERE value > 99.0) AS large,
              arg_min(props, event_id) FILTER (WHERE event_type = 'error') AS problem FROM events""",
)
def first_values(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("buyer"),
        F.when(F.col("value") > 99.0, F.col("value")).alias("large"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("problem"),
    )
    return schema.first_values(events, "event_id", ["buyer", "large", "problem"])


@query("agg_03_keyed_documents", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, n_chars FROM documents")
def keyed_documents(spark, sf_dir):
    stored = table(spark, sf_dir, "documents").select(
        F.format_string("texts/%d", "doc_id").alias("path"), "lang", "n_chars"
    )
    return relation.keyed(stored, "path")


def declared_types(spark, sf_dir):
    """Column descriptions: each order is a table, its lines are the columns, flag and status pick the type name."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    spelled = (
        F.when(flag == "R", F.when(status == "O", "INTEGER").otherwise("STRING"))
        .when(flag == "A", F.when(status == "O", "int").otherwise("string"))
        .otherwise(F.when(status == "O", "int64").otherwise("timestamp[ns]"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("table_name"), F.format_string("line.c%d", "l_linenumber").alias("path"), spelled.alias("type")
    )


_DECLARED = """SELECT l_orderkey AS table_name, 'line.c' || l_linenumber AS path,
    CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'INTEGER' ELSE 'STRING' END
         WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'O' THEN 'int' ELSE 'string' END
         ELSE CASE WHEN l_linestatus = 'O' THEN 'int64' ELSE 'timestamp[ns]' END END AS type FROM lineitem"""
# What the five dialects make of the six names above; one name of the dialect that knows none of them.
_MAPPING = """(VALUES ('warehouse', 'INTEGER', 'int'), ('warehouse', 'STRING', 'str'), ('str', 'int', 'int'),
    ('python', '<class ''int''>', 'int'), ('pandas', 'string', 'str'), ('arrow', 'int64', 'int'), ('arrow', 'string', 'str'),
    ('arrow', 'timestamp[ns]', 'datetime')) AS m(dialect, name, canonical)"""


@query(
    "agg_04_type_matches",
    f"""WITH d AS ({_DECLARED}), t AS (SELECT DISTINCT table_name FROM d), s AS (SELECT DISTINCT dialect FROM {_MAPPING})
        SELECT t.table_name, s.dialect, count(m.name) AS matches FROM t CROSS JOIN s
        JOIN d ON d.table_name = t.table_name LEFT JOIN {_MAPPING} ON m.dialect = s.dialect AND m.name = d.type
        GROUP BY t.table_name, s.dialect""",
)
def type_matches(spark, sf_dir):
    return dialects.type_match_counts(declared_types(spark, sf_dir))


@query(
    "sch_01_detect_dialect",
    f"""WITH d AS ({_DECLARED}), n AS (SELECT table_name, count(*) AS n FROM d GROUP BY table_name),
        c AS (SELECT d.table_name, m.dialect, count(*) AS k FROM d JOIN {_MAPPING} ON m.name = d.type GROUP BY d.table_name, m.dialect)
        SELECT n.table_name, CASE WHEN count(c.dialect) = 1 THEN min(c.dialect) END AS dialect
        FROM n LEFT JOIN c ON c.table_name = n.table_name AND c.k = n.n GROUP BY n.table_name""",
)
def detect_dialect(spark, sf_dir):
    return dialects.detect_dialects(declared_types(spark, sf_dir))


@query(
    "sch_02_translate",
    f"""WITH d AS ({_DECLARED}), o AS (SELECT *, CASE WHEN type IN ('INTEGER', 'STRING') THEN 'warehouse'
              WHEN type IN ('int', 'string') THEN 'str' ELSE 'arrow' END AS origin FROM d)
        SELECT o.table_name, o.path, t.name AS type FROM o
        LEFT JOIN {_MAPPING} ON m.dialect = o.origin AND m.name = o.type
        LEFT JOIN (VALUES ('int', 'Int64'), ('str', 'string'), ('datetime', 'datetime64[ns]')) AS t(canonical, name)
        ON t.canonical = m.canonical""",
)
def translate(spark, sf_dir):
    kind = F.col("type")
    origin = F.when(kind.isin("INTEGER", "STRING"), "warehouse").when(kind.isin("int", "string"), "str").otherwise("arrow")
    return dialects.translate_types(declared_types(spark, sf_dir), "pandas", origin, errors="null")


@query(
    "win_01_row_number",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_number FROM events",
)
def row_number(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return numbering.number_rows(events, "user_id", ["ts", "event_id"]).drop("ts")


@query(
    "win_01_hot_groups",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS row_number FROM events",
)
def hot_groups(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return numbering.number_rows(events, "event_type", ["-ts", "event_id"]).select("event_id", "row_number")


@query(
    "set_01_concat",
    """SELECT s_nationkey AS nationkey, s_name AS name FROM supplier
       UNION ALL SELECT c_nationkey, c_name FROM customer""",
)
def concat(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"))
    return relation.concat([suppliers, customers])


@query(
    "jn_03_unknown_depth",
    """WITH RECURSIVE tree AS (
         SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent FROM region
         UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
         UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
         UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
       ), down AS (
         SELECT id, id AS root, CAST(0 AS BIGINT) AS depth FROM tree WHERE parent IS NULL
         UNION ALL SELECT t.id, d.root, d.depth + 1 FROM tree t JOIN down d ON t.parent = d.id
       ) SELECT id, root, depth FROM down""",
)
def unknown_depth(spark, sf_dir):
    levels = [("region", "r", "r_regionkey", None, None), ("nation", "n", "n_nationkey", "r", "n_regionkey"), ("customer", "c", "c_custkey", "n", "c_nationkey"), ("orders", "o", "o_orderkey", "c", "o_custkey")]
    tree = relation.concat([
        table(spark, sf_dir, name).select(F.concat(F.lit(mark), key).alias("id"), (F.concat(F.lit(above), up) if up else F.lit(None).cast("string")).alias("parent"))
        for name, mark, key, above, up in levels
    ])
    return lookup.tree_roots(tree, "id", "parent").select("id", "root", "depth")
