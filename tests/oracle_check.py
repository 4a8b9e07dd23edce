"""Compares registered queries with their SQL on DuckDB.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or (not isinstance(value, (list, tuple, dict)) and pd.isna(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def normalised(columns: list[str], rows) -> list[tuple]:
    """Rows as texts, columns sorted by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT", "tinyint": "TINYINT",
}


def compare(spark, connection, sf_dir: str, name: str, function, sql: str | None) -> str:
    """Empty when equal, else what differs. Without SQL the query must only run."""
    df = function(spark, sf_dir)
    got = normalised(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    theirs = {d[0]: str(d[1]) for d in result.description}
    for field in df.schema.fields:
        if SAME_TYPES.get(field.dataType.simpleString()) != theirs[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} against {theirs[field.name]}"
    want = normalised(names, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"row {mine} against {theirs}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from millrace.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="millrace-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    connection, failed = duck(sf_dir), 0
    for name, function in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        begin = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name, function, entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:32} {time.time() - begin:6.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
