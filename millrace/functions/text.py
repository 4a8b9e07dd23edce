"""Log text, payloads, labels and value maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def underscores_to_spaces(text: Column) -> Column:
    return F.translate(text.cast("string"), "_", " ")


def timestamp_label(ts: Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` and the zone name, cut to milliseconds.

    A ``TIMESTAMP`` is shown as the zone's clocks have it, whatever the
    session's zone; a ``TIMESTAMP_NTZ``, which is in no zone, as it is.
    """
    local = ts.cast("timestamp_ntz")
    there = F.convert_timezone(F.current_timezone(), F.lit(zone), local)
    shown = F.when(F.typeof(ts) == "timestamp", there).otherwise(local)
    return F.concat(F.date_format(shown, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(f" {zone}"))


def message_text(payload: Column) -> Column:
    """The ``message`` member of a JSON payload that has one, else the payload itself."""
    return F.coalesce(F.get_json_object(payload, "$.message"), payload)


def log_line(ts: Column, payload: Column) -> Column:
    return F.concat(F.lit("LogEntry - ["), timestamp_label(ts), F.lit("] "), message_text(payload))


# JSON keeps NULL members and full timestamps.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_json_text(column: Column) -> Column:
    return F.to_json(column, JSON_OPTIONS)


def json_payload(*columns) -> Column:
    """The given columns (all, if none) as one JSON text."""
    return to_json_text(F.struct(*(columns or ("*",))))


def map_values(column: Column, mapping: dict, dtype: str | None = None) -> Column:
    """Values replaced through ``mapping``; others stay as they are.

    When the replacements are texts and the column is not, the result is text;
    so it is when the column is text, which ``dtype`` says, and they are not.
    """
    if not mapping:
        return column
    textual = dtype == "string" or any(isinstance(value, str) for value in mapping.values())
    chain = F
    for key, value in mapping.items():
        found = column.isNull() if key is None else column == F.lit(str(key) if dtype == "string" else key)
        chain = chain.when(found, F.lit(str(value) if textual and value is not None else value))
    return chain.otherwise(column.cast("string") if textual else column)


def attempt_status(last_attempt: Column, code: Column) -> Column:
    """The state of a scheduled job from its last attempt and status code."""
    return (
        F.when(last_attempt.isNull(), "Has not run yet")
        .when(F.coalesce(code, F.lit(0)) == 0, "Success")
        .when(code == 2, "Failed")
        .otherwise(code.cast("string"))
    )


def traffic_status(percent: Column) -> Column:
    return F.when(percent > 0, "Active").otherwise("Inactive")
