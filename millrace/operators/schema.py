"""Inferring, enforcing and extending column types.

A column rule is a type (any form ``dialects.spark_type`` takes), a value map,
a function from Column to Column, or a list of rules tried in order.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import cast_or_null
from millrace.functions.text import map_values
from millrace.operators.dialects import SPARK_TYPES, _canonical_of, spark_type

_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]*)?)?"
# Kinds of text from narrow to wide, each with the pattern of its texts; a bit stands for a kind.
_KINDS = {
    "int": r"^[+-]?[0-9]+$",
    "float": r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "datetime": rf"{_TIME}\s*$",
    # An offset, Z or a zone's name follows: a moment, which a type without a zone can't hold.
    "zoned": rf"{_TIME}\s*([zZ]|[+-][0-9]|[A-Za-z])",
}
_WORDS = {"float": ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan"], "bool": ["true", "false"]}
_BITS = {kind: 1 << place for place, kind in enumerate([*_KINDS, "bool", "str"])}
# A column has the first type that takes in all kinds found in it.
_TYPES = {
    "int": ["int"], "float": ["int", "float"], "date": ["date"], "datetime": ["date", "datetime"],
    "timestamp": ["zoned"], "bool": ["bool"],
}


def per_element(function: Callable, returns) -> Callable[[Column], Column]:
    """A rule that applies a Python function to each value, in Arrow batches."""

    def apply(values: pd.Series) -> pd.Series:
        return values.map(function, na_action="ignore")

    return F.pandas_udf(apply, spark_type(returns))


def per_batch(function: Callable, returns) -> Callable[[Column], Column]:
    """A rule that applies a pandas Series function to each Arrow batch of the column."""

    def apply(values: pd.Series) -> pd.Series:
        return function(values)

    return F.pandas_udf(apply, spark_type(returns))


def _is_type(rule) -> bool:
    return isinstance(rule, (str, type, T.DataType))


def _apply(column: Column, rule, dtype: str | None = None) -> Column:
    if _is_type(rule):
        return column.cast(spark_type(rule))
    if isinstance(rule, dict):
        return map_values(column, rule, dtype)
    if callable(rule):
        return rule(column)
    raise TypeError(f"unsupported column rule: {rule!r}")


def cast_failures(df: DataFrame, checks: list[tuple[str, object]]) -> list[int]:
    """How many values of each column cannot be cast to the paired type.

    All checks share one aggregation, so ``df`` is scanned once and one row
    comes back. A pair of types that never cast counts as one failure.
    """
    counted: list[Column] = []
    for name, target in checks:
        value = F.col(f"`{name}`")
        attempt = cast_or_null(value, df.select(value).schema[0].dataType, spark_type(target))
        try:
            df.select(attempt)
            counted.append(F.count_if(value.isNotNull() & attempt.isNull()))
        except AnalysisException:
            counted.append(F.lit(1).cast("bigint"))
    if not counted:
        return []
    row = df.agg(F.count(F.lit(1)), *[c.alias(f"c{i}") for i, c in enumerate(counted)]).first()
    return list(row)[1:]


def add_missing(df: DataFrame, columns: dict) -> DataFrame:
    """Columns that ``df`` lacks are added as NULLs of the given type."""
    have = {name.lower() for name in df.columns}
    missing = {n: F.lit(None).cast(spark_type(t)) for n, t in columns.items() if n.lower() not in have}
    return df.withColumns(missing) if missing else df


def enforce(df: DataFrame, schema: dict | None = None, dtypes: dict | None = None, errors: str = "raise") -> DataFrame:
    """``df`` with each column rule applied; ``schema`` overrides ``dtypes``.

    With ``errors="ignore"`` a column keeps its type when any value fails.
    """
    rules = {**(dtypes or {}), **(schema or {})}
    if not rules:
        return df
    have = {name.lower() for name in df.columns}
    absent = [name for name in rules if name.lower() not in have]
    df = df.withColumns({name: F.lit(None) for name in absent}) if absent else df

    checks: list[tuple[str, object]] = []
    for name, rule in rules.items():
        if isinstance(rule, list):
            checks += [(name, candidate) for candidate in rule if _is_type(candidate)]
        elif errors == "ignore" and _is_type(rule):
            checks.append((name, rule))
    failures = {
        (name, repr(rule)): failed for (name, rule), failed in zip(checks, cast_failures(df, checks))
    }

    changed: dict[str, Column] = {}
    types = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    for name, rule in rules.items():
        if isinstance(rule, list):
            if any(callable(c) and not _is_type(c) for c in rule[:-1]):
                raise ValueError(f"a function can't be tried before the rules of {name} after it: put it last")
            rule = next((c for c in rule if not failures.get((name, repr(c)))), None)
            if rule is None and errors == "ignore":
                continue
            if rule is None:
                raise ValueError(f"no rule of {rules[name]} fits column {name}")
        elif failures.get((name, repr(rule))):
            continue
        try:
            changed[name] = _apply(F.col(f"`{name}`"), rule, types[name.lower()])
            df.select(changed[name])
        except (AnalysisException, TypeError, ValueError):
            if errors == "raise":
                raise
            del changed[name]
    return df.withColumns(changed) if changed else df


def _storable_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.NullType):
        return T.BooleanType()
    if isinstance(dtype, T.TimeType):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_storable_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _storable_type(f.dataType), f.nullable) for f in dtype.fields])
    return dtype


def storable(df: DataFrame) -> DataFrame:
    """``df`` with types that files hold: NULL-only columns as booleans, times as text, at any depth."""
    changed = {
        f.name: F.col(f"`{f.name}`").cast(_storable_type(f.dataType))
        for f in df.schema.fields
        if _storable_type(f.dataType) != f.dataType
    }
    return df.withColumns(changed) if changed else df


def first_values(df: DataFrame, order_by: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """One row: the first value of each column that is not NULL, in the given order."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    key = F.struct(*order)
    names = columns or df.columns
    return df.agg(*[F.min_by(n, F.when(F.col(n).isNotNull(), key)).alias(n) for n in names])


def _kind_bit(value: Column) -> Column:
    """The bit of the narrowest kind of a text, NULL for NULL."""
    word = F.lower(value)
    words = F
    for kind, texts in _WORDS.items():
        words = words.when(word.isin(texts), _BITS[kind])
    words = words.otherwise(_BITS["str"])
    numbers = F
    for kind, pattern in _KINDS.items():
        fits = value.rlike(pattern)
        if kind != "float":  # digits may be out of range
            fits = F.when(fits, value.try_cast(SPARK_TYPES["timestamp" if kind == "zoned" else kind]).isNotNull())
        numbers = numbers.when(fits, _BITS[kind])
    # Digits and signs sort before the colon, so most other text skips the patterns.
    return F.when(value.isNull(), None).when(value < ":", numbers.otherwise(words)).otherwise(words)


def infer_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, type)``: the narrowest canonical type that fits every value of a column.

    Text is tried as int, float, date, datetime, timestamp and bool; columns of
    other types keep theirs. Times with an offset or a zone are ``timestamp``,
    those without are ``datetime``, and a column with both is ``str``. A text column without values is ``null``. Every value
    is classed once and the classes of a column are or-ed together.
    """
    texts: list[Column] = []
    entries: list[Column] = []
    for name in columns or df.columns:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.StringType):
            texts.append(F.bit_or(_kind_bit(F.col(f"`{name}`"))).alias(name))
            found = F.col(f"`{name}`")
            kind = F.when(found.isNull(), "null")
            for canonical, kinds in _TYPES.items():
                others = ~sum(_BITS[k] for k in kinds)
                kind = kind.when(found.bitwiseAND(F.lit(others)) == 0, canonical)
            kind = kind.otherwise("str")
        else:
            kind = F.lit(_canonical_of(dtype))
        entries.append(F.struct(F.lit(name).alias("column_name"), kind.alias("type")))
    return df.agg(F.count(F.lit(1)).alias("#rows"), *texts).select(F.inline(F.array(*entries)))


def infer_json_type(df: DataFrame, column: str) -> DataFrame:
    """One row ``(type)``: the type, in DDL, that fits all JSON texts of a column."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("type"))


def best_types(df: DataFrame) -> DataFrame:
    """Text columns cast to the type ``infer_types`` finds; the rest unchanged."""
    inferred = {row["column_name"]: row["type"] for row in infer_types(df).collect()}
    casts = {
        name: F.col(f"`{name}`").cast(SPARK_TYPES[kind])
        for name, kind in inferred.items()
        if isinstance(df.schema[name].dataType, T.StringType) and kind not in ("str", "null")
    }
    return df.withColumns(casts) if casts else df
