"""Type names in five dialects: matching, detection and translation.

The input is a table of column descriptions, one row per column with a table
key, a (dotted) path and a type name, so schemas of any number of tables are
handled in one job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The name of each canonical type in each dialect. Python types
# are spelled as their text form. The order matters, see ``_inverse``.
DIALECTS = {
    "warehouse": {
        "null": "BOOLEAN", "int": "INTEGER", "float": "FLOAT", "str": "STRING",
        "bool": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE", "time": "TIME",
        "datetime": "DATETIME", "bytes": "BYTES", "array": "ARRAY", "struct": "STRUCT",
    },
    "str": {
        "int": "int", "float": "float", "str": "str", "bool": "bool",
        "timestamp": "timestamp", "date": "date", "time": "time", "datetime": "datetime",
        "bytes": "bytes", "array": "array", "struct": "struct", "null": "null",
    },
    "python": {
        "int": "<class 'int'>", "float": "<class 'float'>", "str": "<class 'str'>",
        "bool": "<class 'bool'>", "timestamp": "<class 'datetime.datetime'>",
        "date": "<class 'datetime.date'>", "time": "<class 'datetime.time'>",
        "datetime": "<class 'datetime.datetime'>", "bytes": "<class 'bytes'>",
        "array": "<class 'list'>", "struct": "<class 'dict'>", "null": "<class 'NoneType'>",
    },
    "pandas": {
        "int": "Int64", "float": "Float64", "str": "string", "bool": "boolean",
        "timestamp": "datetime64[ns]", "date": "datetime64[ns]", "time": "datetime64[ns]",
        "datetime": "datetime64[ns]", "bytes": "bytes", "array": "list", "struct": "struct",
        "null": "object",
    },
    "arrow": {
        "int": "int64", "float": "double", "str": "string", "bool": "bool",
        "timestamp": "timestamp[ns]", "date": "date32", "time": "time64[ns]",
        "datetime": "timestamp[ns]", "bytes": "binary", "array": "list", "struct": "struct",
        "null": "null",
    },
}
# The Spark type of each canonical type that has no parts.
SPARK_TYPES = {
    "int": T.LongType(), "float": T.DoubleType(), "str": T.StringType(), "bool": T.BooleanType(),
    "timestamp": T.TimestampType(), "datetime": T.TimestampNTZType(), "date": T.DateType(),
    "time": T.TimeType(6), "bytes": T.BinaryType(), "null": T.NullType(),
}
# Further names of a dialect that are read but not written.
ALIASES = {"warehouse": {"RECORD": "struct"}}


def _inverse(dialect: str) -> dict[str, str]:
    """Type name to canonical name; of several canonical names the last one counts."""
    names = {name: canonical for canonical, name in DIALECTS[dialect].items()}
    return names | ALIASES.get(dialect, {})


def mapping_table(spark: SparkSession) -> DataFrame:
    """``(dialect, name, canonical)``, one row per name a dialect knows."""
    rows = [(d, name, canonical) for d in DIALECTS for name, canonical in _inverse(d).items()]
    return spark.createDataFrame(rows, "dialect string, name string, canonical string")


def _match_counts(descriptions: DataFrame, table: str, type_name: str) -> DataFrame:
    """Per table: its column count, and per dialect how many of its type names the dialect has."""
    known_by = {dialect: _inverse(dialect) for dialect in DIALECTS}
    names = dict.fromkeys(name for inverse in known_by.values() for name in inverse)
    rows = [(name, *[name in inverse for inverse in known_by.values()]) for name in names]
    flags = ", ".join(f"_{dialect} boolean" for dialect in DIALECTS)
    lookup = descriptions.sparkSession.createDataFrame(rows, f"_name string, {flags}")
    # The lookup holds the fixed names above and nothing else, so it is always broadcast.
    known = descriptions.join(F.broadcast(lookup), F.col(type_name) == F.col("_name"), "left")
    return known.groupBy(table).agg(
        F.count(F.lit(1)).alias("n_columns"),
        *[F.count_if(F.col(f"_{d}")).alias(d) for d in DIALECTS],
    )


def type_match_counts(descriptions: DataFrame, table: str = "table_name", type_name: str = "type") -> DataFrame:
    """``(table, dialect, matches)`` for every table and dialect."""
    counts = _match_counts(descriptions, table, type_name)
    return counts.select(
        table,
        F.inline(F.array(*[F.struct(F.lit(d).alias("dialect"), F.col(d).alias("matches")) for d in DIALECTS])),
    )


def detect_dialects(descriptions: DataFrame, table: str = "table_name", type_name: str = "type") -> DataFrame:
    """``(table, dialect)``: the one dialect that has all type names of the table, else NULL."""
    counts = _match_counts(descriptions, table, type_name)
    complete = F.filter(
        F.array(*[F.when(F.col(d) == F.col("n_columns"), F.lit(d)) for d in DIALECTS]),
        lambda d: d.isNotNull(),
    )
    return counts.select(table, F.when(F.size(complete) == 1, complete[0]).alias("dialect"))


def translate_types(
    descriptions: DataFrame,
    target: str,
    origin: str | Column = "str",
    type_name: str = "type",
    errors: str = "raise",
) -> DataFrame:
    """The type names of ``descriptions`` in the ``target`` dialect.

    ``origin`` is a dialect name, or a column holding one per row. Names that
    the origin does not know raise, or become NULL with ``errors="null"``.
    """
    for dialect in [target] + ([origin] if isinstance(origin, str) else []):
        if dialect not in DIALECTS:
            raise ValueError(f"unknown dialect: {dialect}")
    rows = [
        (d, name, DIALECTS[target][canonical])
        for d in DIALECTS
        for name, canonical in _inverse(d).items()
    ]
    lookup = descriptions.sparkSession.createDataFrame(
        rows, "_dialect string, _name string, _translated string"
    )
    origin_column = F.lit(origin) if isinstance(origin, str) else origin
    joined = descriptions.withColumn("_origin", origin_column).join(
        F.broadcast(lookup),
        (F.col("_origin") == F.col("_dialect")) & (F.col(type_name) == F.col("_name")),
        "left",
    )
    translated = F.col("_translated")
    if errors == "raise":
        problem = F.concat(F.lit("unknown type name: "), F.coalesce(F.col(type_name), F.lit("NULL")))
        translated = F.coalesce(translated, F.raise_error(problem).cast("string"))
    return joined.withColumn(type_name, translated).select(descriptions.columns)


def canonical_name(name) -> str:
    """The canonical name behind a type name of any dialect, or a Python type."""
    if isinstance(name, type):
        name = str(name)
    for dialect in ("str", "python", "warehouse", "arrow", "pandas"):
        inverse = _inverse(dialect)
        if name in inverse:
            return inverse[name]
    raise ValueError(f"unknown type name: {name}")


def spark_type(spec) -> T.DataType:
    """A Spark type from a type name, Python type, ``[element]``, ``{field: type}`` or DDL text."""
    if isinstance(spec, T.DataType):
        return spec
    if isinstance(spec, dict):
        return T.StructType([T.StructField(name, spark_type(part), True) for name, part in spec.items()])
    if isinstance(spec, list):
        if len(spec) != 1:
            raise ValueError(f"a repeated type needs exactly one element type: {spec}")
        return T.ArrayType(spark_type(spec[0]))
    if isinstance(spec, type) and spec in (list, dict, tuple):
        raise ValueError(f"give the parts of {spec.__name__}, as [type] or {{name: type}}")
    try:
        canonical = canonical_name(spec)
    except ValueError:
        return T.DataType.fromDDL(spec)
    if canonical not in SPARK_TYPES:
        raise ValueError(f"give the parts of {spec}, as [type] or {{name: type}}")
    return SPARK_TYPES[canonical]


def _canonical_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dtype, T.TimeType):
        return "time"
    for canonical, known in SPARK_TYPES.items():
        if type(known) is type(dtype):
            return canonical
    return dtype.simpleString()


def _walk(schema: T.StructType, prefix: str = ""):
    """``(path, canonical type)`` of every column; struct fields are dotted, elements end in ``[]``."""
    for field in schema.fields:
        path, dtype = prefix + field.name, field.dataType
        while isinstance(dtype, T.ArrayType):
            yield path, "array"
            path, dtype = path + "[]", dtype.elementType
        if isinstance(dtype, T.StructType):
            yield path, "struct"
            yield from _walk(dtype, path + ".")
        else:
            yield path, _canonical_of(dtype)


def describe_columns(df: DataFrame, table_name: str) -> DataFrame:
    """``(table_name, path, type)``, one row per column or nested field of ``df``."""
    rows = [(table_name, path, kind) for path, kind in _walk(df.schema)]
    return df.sparkSession.createDataFrame(rows, "table_name string, path string, type string")


_PYTHON_SPARK = {  # values a caller may hold in rows
    bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType(),
    bytes: T.BinaryType(), dt.datetime: T.TimestampNTZType(), dt.date: T.DateType(),
    dt.time: T.TimeType(6),
}


def type_of_values(values) -> T.DataType:
    """The Spark type of a list of Python values, from all that are not None."""
    present = [value for value in values if value is not None]
    if not present:
        return T.NullType()
    if all(isinstance(value, dict) for value in present):
        names = list(dict.fromkeys(name for value in present for name in value))
        return T.StructType(
            [T.StructField(n, type_of_values([v.get(n) for v in present]), True) for n in names]
        )
    if all(isinstance(value, (list, tuple)) for value in present):
        return T.ArrayType(type_of_values([item for value in present for item in value]))
    kinds = {type(value) for value in present}
    if kinds == {int, float}:
        return T.DoubleType()
    if len(kinds) == 1 and (kind := kinds.pop()) in _PYTHON_SPARK:
        return _PYTHON_SPARK[kind]
    raise ValueError("values of different types need a schema")
