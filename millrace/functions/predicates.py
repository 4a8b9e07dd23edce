"""Filter lists, equality maps and membership maps as Spark predicates.

A filter is a tuple ``(column, operator, value)`` or a dict ``{column: values}``
meaning membership. The literals take the type of the column they are compared
with, so that the predicate reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The operators of a table read, and those a file read adds.
TABLE_OPERATORS = ("=", ">", "<", ">=", "<=", "IN", "LIKE")
FILE_OPERATORS = TABLE_OPERATORS + ("==", "!=", "NOT IN")

_COMPARE: dict[str, Callable] = {
    "=": eq, "==": eq, "!=": ne, ">": gt, "<": lt, ">=": ge, "<=": le,
}


def as_list(value) -> list:
    """A scalar becomes a one-element list; lists, tuples and sets become lists."""
    return list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]


def resolve(schema: T.StructType, name: str) -> tuple[Column, T.DataType]:
    """The column and type behind ``name``, which may be a dotted path into structs."""
    fields = {field.name.lower(): field for field in schema.fields}
    if name.lower() in fields:
        return F.col(f"`{name}`"), fields[name.lower()].dataType
    head, _, rest = name.partition(".")
    parent = fields.get(head.lower())
    if not rest or parent is None or not isinstance(parent.dataType, T.StructType):
        raise ValueError(f"unknown column: {name}")
    _, dtype = resolve(parent.dataType, rest)
    return F.col(name), dtype


def literal(value, dtype: T.DataType) -> Column:
    """``value`` as a literal comparable with a column of type ``dtype``."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            if isinstance(dtype, T.TimestampType):
                return F.lit(value.isoformat()).cast("timestamp")
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        target = "timestamp" if isinstance(dtype, T.TimestampType) else "timestamp_ntz"
        return F.lit(value.isoformat(sep=" ")).cast(target)
    return F.lit(value)


def predicate(schema: T.StructType, item, operators: Iterable[str] = TABLE_OPERATORS) -> Column:
    """One filter as a predicate. All keys of a dict filter must match."""
    if isinstance(item, dict):
        return conjunction(schema, [(name, "IN", value) for name, value in item.items()], operators)
    name, op, value = item
    op = op.upper()
    if op not in operators:
        raise ValueError(f"operator not allowed: {op}")
    column, dtype = resolve(schema, name)
    if op in ("IN", "NOT IN"):
        member = column.isin([literal(v, dtype) for v in as_list(value)])
        return ~member if op == "NOT IN" else member
    if isinstance(value, (list, tuple, set, frozenset)):
        raise ValueError(f"operator {op} needs one value, got a list for {name}")
    if op == "LIKE":
        return column.like(str(value))
    return _COMPARE[op](column, literal(value, dtype))


def conjunction(schema: T.StructType, filters, operators: Iterable[str] = TABLE_OPERATORS) -> Column | None:
    """All filters must hold; None when there are none."""
    if not filters:
        return None
    if isinstance(filters, dict):
        filters = [filters]
    return reduce(and_, [predicate(schema, item, operators) for item in filters])


def disjunction(schema: T.StructType, groups, operators: Iterable[str] = FILE_OPERATORS) -> Column | None:
    """An OR of ANDs: ``groups`` is a list of filter lists."""
    parts = [part for part in (conjunction(schema, g, operators) for g in groups) if part is not None]
    return reduce(or_, parts) if parts else None


def where(df: DataFrame, filters, operators: Iterable[str] = TABLE_OPERATORS) -> DataFrame:
    """``df`` restricted to the rows that pass all filters."""
    condition = conjunction(df.schema, filters, operators)
    return df if condition is None else df.where(condition)


def where_file(df: DataFrame, filters) -> DataFrame:
    """As ``where``, with the file-read operators and lists of filter lists (OR of ANDs)."""
    if filters and isinstance(filters, list) and isinstance(filters[0], list):
        condition = disjunction(df.schema, filters)
        return df if condition is None else df.where(condition)
    return where(df, filters, FILE_OPERATORS)


def membership(filters) -> list | None:
    """``{column: value or values}`` as a list of ``(column, "in", values)``; lists pass through."""
    if filters is None or isinstance(filters, list):
        return filters
    return [(name, "in", as_list(value)) for name, value in filters.items()]


def where_equal(df: DataFrame, values: dict | None) -> DataFrame:
    """Rows whose columns equal the given values."""
    return where(df, [(name, "=", value) for name, value in (values or {}).items()])


def starts_with_any(column: Column, prefixes: Iterable[str]) -> Column:
    """True when the text starts with one of the prefixes."""
    return reduce(or_, [column.startswith(prefix) for prefix in prefixes], F.lit(False))


def every(array: Column, test: Callable[[Column], Column]) -> Column:
    """True when all elements pass; an empty or missing array passes."""
    return F.coalesce(F.forall(array, lambda item: F.coalesce(test(item), F.lit(False))), F.lit(True))


def in_state(column: Column, states) -> Column:
    """True when the state is one of ``states``."""
    return column.isin(as_list(states))
