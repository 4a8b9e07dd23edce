"""SQL text with named parameters and a typed result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.schema import enforce


def _bound(value):
    """A datetime without a zone as a literal without one, which no session zone moves; all else as it is."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")
    if isinstance(value, (list, tuple)) and any(isinstance(v, dt.datetime) for v in value):
        return F.array(*[F.lit(_bound(v)) for v in value])
    return value


def query(spark: SparkSession, sql: str, params: dict | None = None, schema: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL text: ``:name`` stands for a parameter, ``{name}`` for a frame given by keyword.

    Parameters keep their Python types; lists become arrays. A datetime without
    a zone is a ``TIMESTAMP_NTZ``, one with a zone a ``TIMESTAMP``.
    """
    args = {name: _bound(value) for name, value in params.items()} if params else params
    return enforce(spark.sql(sql, args=args, **tables), schema)
