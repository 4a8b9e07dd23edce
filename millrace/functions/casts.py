"""Casts of text that give NULL instead of failing, cheaply.

``try_cast`` raises and catches an exception for each text it cannot cast,
which costs far more than the cast. So a pattern that every castable text
matches is tested first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"(?s)^[\x00-\x20]*[+-]?(([0-9]|\.[0-9])[0-9a-fA-FxXpP.+-]*|(?i:inf(inity)?|nan))[dDfF]?[\x00-\x20]*$"
_DATE = r"(?s)^[\x00-\x20]*[+-]?[0-9]{4,7}(-[0-9]{1,2}(-[0-9]{1,2}([ T].*)?)?)?[\x00-\x20]*$"
_TIMESTAMP = r"(?s)^[\x00-\x20]*([+-]?[0-9]{4,7}([-\x00-\x20].*)?|T?[0-9]{1,2}:.*)$"
# Patterns that all texts of a type match; a text that matches may still not be one.
GUARDS = {
    T.ByteType: r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$",
    T.ShortType: r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$",
    T.IntegerType: r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$",
    T.LongType: r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$",
    T.FloatType: _NUMBER,
    T.DoubleType: _NUMBER,
    T.DecimalType: _NUMBER,
    T.DateType: _DATE,
    T.TimestampType: _TIMESTAMP,
    T.TimestampNTZType: _TIMESTAMP,
    T.BooleanType: r"^[\x00-\x20]*(?i:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20]*$",
}


def cast_or_null(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` as ``target``, NULL where that fails."""
    guard = GUARDS.get(type(target)) if isinstance(source, T.StringType) else None
    attempt = value.try_cast(target)
    return attempt if guard is None else F.when(value.rlike(guard), attempt)


def has_hash(dtype: T.DataType) -> bool:
    """Whether Spark hashes values of the type: maps and variants have no hash, at any depth."""
    if isinstance(dtype, T.ArrayType):
        return has_hash(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(has_hash(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))
