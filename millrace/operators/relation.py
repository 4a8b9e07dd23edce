"""Projection, limits, order, newest rows, concatenation and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.predicates import as_list, resolve, where_equal


def project(df: DataFrame, columns=None) -> DataFrame:
    """The named columns; all of them for None or when only ``*`` is named."""
    names = [name for name in as_list(columns) if name != "*"] if columns is not None else []
    if not names:
        return df
    return df.select([resolve(df.schema, name)[0] for name in names])


def limit_rows(df: DataFrame, n: int | None) -> DataFrame:
    """At most ``n`` rows; anything but a positive whole number means no limit."""
    if isinstance(n, int) and not isinstance(n, bool) and n > 0:
        return df.limit(n)
    return df


def _sort_keys(order_by) -> list[Column]:
    """Sort keys from Columns, names, ``-name`` or ``name desc``."""
    keys = []
    for item in as_list(order_by):
        if isinstance(item, Column):
            keys.append(item)
            continue
        name, _, direction = item.strip().partition(" ")
        descending = name.startswith("-") or direction.strip().lower() == "desc"
        column = F.col(name.lstrip("-"))
        keys.append(column.desc() if descending else column.asc())
    return keys


def order_rows(df: DataFrame, order_by=None) -> DataFrame:
    return df.orderBy(*_sort_keys(order_by)) if order_by else df


def fetch(df: DataFrame, filters: dict | None = None, order_by=None, limit: int | None = None) -> DataFrame:
    """Rows equal to ``filters``, ordered, cut to ``limit``."""
    return limit_rows(order_rows(where_equal(df, filters), order_by), limit)


def fetch_one(df: DataFrame, filters: dict | None = None, order_by=None) -> DataFrame:
    """The first row under the order, or no row."""
    return fetch(df, filters, order_by, 1)


def newest_first(df: DataFrame, time: str, tie_break: str | None = None, limit: int | None = None) -> DataFrame:
    keys = [F.col(time).desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    return limit_rows(df.orderBy(*keys), limit)


def keep_newest(df: DataFrame, by, time: str, row_id: str, n: int = 2) -> DataFrame:
    """The newest ``n`` rows of each group; ``row_id`` breaks ties in time.

    Every map task passes on at most ``n`` rows per group (WindowGroupLimit),
    so a hot group never meets in one task. Spark does so up to a bound on
    ``n``; beyond it the rows are numbered over many tasks.
    """
    rank = "_rank"
    while rank in df.columns:
        rank += "_"
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        from millrace.operators.numbering import number_rows

        return number_rows(df, by, [f"{time} desc", f"{row_id} desc"], rank).where(F.col(rank) <= n).drop(rank)
    window = Window.partitionBy(*as_list(by)).orderBy(F.col(time).desc(), F.col(row_id).desc())
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n).drop(rank)


def drop_newest(df: DataFrame, by, time: str, row_id: str, n: int = 2) -> DataFrame:
    """All but the newest ``n`` rows of each group; ``row_id`` must be unique.

    The kept rows are found as in ``keep_newest`` and taken out by their ids,
    so the rows are spread by id and not by group.
    """
    kept = keep_newest(df.select(*as_list(by), time, row_id), by, time, row_id, n)
    return df.join(kept.select(row_id), row_id, "left_anti")


def concat(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_count(df: DataFrame, table_name: str) -> DataFrame:
    """One row ``(table_name, num_rows)``."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(table_name).alias("table_name"), "num_rows")


def keyed(df: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Documents keyed by the last segment of their path, one row each."""
    return df.select(F.substring_index(path, "/", -1).alias(key), *[c for c in df.columns if c != path])


def all_rows_pass(df: DataFrame, by, test: Column, name: str = "passes") -> DataFrame:
    """Per group, whether every row passes; a test that gives NULL does not pass."""
    return df.groupBy(*as_list(by)).agg(F.bool_and(F.coalesce(test, F.lit(False))).alias(name))
