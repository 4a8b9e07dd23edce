"""Log search over a table of entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import literal, resolve
from millrace.functions.text import log_line, message_text, timestamp_label
from millrace.operators.relation import limit_rows, order_rows

# Fixed value: the row cap of a search that names neither a condition nor a limit.
DEFAULT_LIMIT = 100


def log_conditions(
    df: DataFrame,
    query: str | Column | None = None,
    severity: str | None = None,
    time_start: dt.datetime | None = None,
    time_end: dt.datetime | None = None,
    time_range: float | None = None,
    now: dt.datetime | None = None,
    time: str = "timestamp",
    level: str = "severity",
) -> list[Column]:
    """The predicates of a search; both time bounds count as inside.

    ``time_range`` looks that many hours back from ``now`` and replaces the bounds.
    """
    if time_range:
        time_end = now or dt.datetime.now(dt.timezone.utc)
        time_start = time_end - dt.timedelta(hours=time_range)
    column, dtype = resolve(df.schema, time)
    conditions: list[Column] = []
    if query is not None:
        conditions.append(F.expr(query) if isinstance(query, str) else query)
    if severity:
        conditions.append(F.col(level) == F.lit(severity))
    if time_start is not None:
        conditions.append(column >= literal(time_start, dtype))
    if time_end is not None:
        conditions.append(column <= literal(time_end, dtype))
    return conditions


def search_logs(
    df: DataFrame, query=None, severity=None, limit: int | None = None, time_start=None, time_end=None,
    time_range=None, order_by=None, now=None, time: str = "timestamp", level: str = "severity",
    default_limit: int | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Matching entries, newest first unless ``order_by`` says otherwise.

    With no condition and no limit, the first ``default_limit``; None gives all.
    """
    conditions = log_conditions(df, query, severity, time_start, time_end, time_range, now, time, level)
    for condition in conditions:
        df = df.where(condition)
    if limit is None and not conditions:
        limit = default_limit
    return limit_rows(order_rows(df, order_by or f"{time} desc"), limit)


def with_entry_text(df: DataFrame, time: str = "timestamp", message: str = "message") -> DataFrame:
    """Entries with their time label, message text and printed line."""
    ts, payload = F.col(time), F.col(message)
    return df.withColumns(
        {"timestamp_str": timestamp_label(ts), "message_str": message_text(payload), "line": log_line(ts, payload)}
    )
