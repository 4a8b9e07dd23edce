"""Derived partition columns for time and range partitioning, and the predicates they imply."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import has_hash
from millrace.functions.predicates import as_list, literal

_DAY_SECONDS = 86_400


@dataclass(frozen=True)
class TimePartition:
    """One partition per day of a date or timestamp column.

    Days of timestamps with a zone are days in UTC, whatever the session's
    zone, so that a table can be written in one zone and read in another.
    """

    column: str

    @property
    def partition(self) -> str:
        return f"{self.column}__day"

    def derive(self, value: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.TimestampType):
            return F.date_from_unix_date(F.floor(F.unix_seconds(value) / _DAY_SECONDS).cast("int"))
        return F.to_date(value)

    def implied(self, op: str, value, dtype: T.DataType) -> Column | None:
        """The partition predicate that follows from ``column op value``."""
        day = F.col(self.partition)
        days = [self.derive(literal(v, dtype).cast(dtype), dtype) for v in as_list(value)]
        if op == "IN":
            return day.isin(days)
        bound = days[0]
        return {"=": day == bound, ">": day >= bound, ">=": day >= bound, "<": day <= bound, "<=": day <= bound}.get(op)

    def describe(self) -> str:
        return self.column


@dataclass(frozen=True)
class RangePartition:
    """One partition per ``interval`` of a whole-number column between ``start`` and ``end``.

    The partition value is the lower bound; values outside go to the NULL partition.
    """

    column: str
    start: int
    end: int
    interval: int

    def __post_init__(self):
        if self.interval <= 0 or self.end <= self.start:
            raise ValueError("a range partition needs start < end and interval > 0")

    @property
    def partition(self) -> str:
        return f"{self.column}__range"

    def derive(self, value: Column, dtype: T.DataType | None = None) -> Column:
        inside = (value >= self.start) & (value < self.end)
        return F.when(inside, (value - F.pmod(value - self.start, F.lit(self.interval))).cast("bigint"))

    def implied(self, op: str, value, dtype: T.DataType) -> Column | None:
        lower, values = F.col(self.partition), as_list(value)
        if not all(isinstance(v, (int, float)) for v in values):
            return None
        bounds = [self.derive(F.lit(v)) for v in values]
        # Values outside all ranges may be anywhere below or above, so NULL always stays in.
        if op in ("IN", "="):
            return lower.isin(bounds) | lower.isNull()
        if op in (">", ">="):
            return (lower > F.lit(values[0] - self.interval)) | lower.isNull()
        if op in ("<", "<="):
            return (lower <= F.lit(values[0])) | lower.isNull()
        return None

    def describe(self) -> str:
        return f"{self.column},{self.start},{self.end},{self.interval}"


def with_layout(df: DataFrame, layout) -> DataFrame:
    """``df`` with the derived partition column."""
    dtype = df.schema[layout.column].dataType
    return df.withColumn(layout.partition, layout.derive(F.col(layout.column), dtype))


# Table properties that record a derived partition column.
TIME_PROPERTY = "millrace.time_partition"
RANGE_PROPERTY = "millrace.range_partition"


def layout_properties(layout) -> dict[str, str]:
    name = TIME_PROPERTY if isinstance(layout, TimePartition) else RANGE_PROPERTY
    return {name: layout.describe()}


def layout_from_properties(properties: dict[str, str]):
    if TIME_PROPERTY in properties:
        return TimePartition(properties[TIME_PROPERTY])
    if RANGE_PROPERTY in properties:
        column, *numbers = properties[RANGE_PROPERTY].rsplit(",", 3)
        return RangePartition(column, *map(int, numbers))
    return None


def prune(df: DataFrame, layout, filters) -> DataFrame:
    """``df`` restricted to the partitions that can pass ``filters``.

    Spark prunes on the partition column itself only, so the predicate that a
    filter on the source column implies is added here.
    """
    for item in ([filters] if isinstance(filters, dict) else filters or []):
        triples = [(n, "IN", v) for n, v in item.items()] if isinstance(item, dict) else [item]
        for name, op, value in triples:
            if name.lower() != layout.column.lower():
                continue
            if isinstance(layout, TimePartition) and not all(
                isinstance(v, (dt.date, dt.datetime, str)) for v in as_list(value)
            ):
                continue
            implied = layout.implied(op.upper(), value, df.schema[layout.column].dataType)
            df = df if implied is None else df.where(implied)
    return df


def clustered(df: DataFrame, columns: list[str], within: list[str] | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by the cluster columns, within the partition columns.

    A row hash ends the range key, so many rows of equal cluster values still
    spread over tasks; the sort leaves it out.
    """
    leading = [*(within or []), *columns]
    hashed = [f.name for f in df.schema.fields if has_hash(f.dataType)]
    return df.repartitionByRange(*leading, F.xxhash64(*hashed)).sortWithinPartitions(*leading)
