"""Row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.predicates import as_list
from millrace.operators.relation import _sort_keys
from millrace.session import materialise

# monotonically_increasing_id puts the partition number above the row number at this bit.
_PARTITION_BIT = 33


def number_rows(df: DataFrame, by, order_by, name: str = "row_number", start: int = 1) -> DataFrame:
    """Consecutive numbers within each group, in an order that must be unique there.

    The rows are range-partitioned by group and order, so a hot group spans
    many tasks. They are written once with their ids; then one row per group
    and partition gives each stretch of a group its first number. No column of
    ``df`` is lost, but one called ``name`` is replaced.
    """
    groups = as_list(by)
    row, part, first, count, before = _free(df, "_id", "_part", "_first", "_rows", "_before")
    ordered = df.repartitionByRange(*[F.col(g) for g in groups], *_sort_keys(order_by))
    ordered = ordered.sortWithinPartitions(*[F.col(g) for g in groups], *_sort_keys(order_by))
    rows = materialise(ordered.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(row, _PARTITION_BIT))

    stretches = rows.groupBy(part, *groups).agg(F.min(row).alias(first), F.count(F.lit(1)).alias(count))
    # One row per partition that holds a piece of the group.
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0)))

    keys = [part, *groups]
    stretches = stretches.select(*[F.col(k).alias(f"{before}{i}") for i, k in enumerate(keys)], first, before)
    same = [F.col(k).eqNullSafe(F.col(f"{before}{i}")) for i, k in enumerate(keys)]
    number: Column = F.col(row) - F.col(first) + F.col(before) + F.lit(start)
    kept = [c for c in df.columns if c != name]
    return rows.join(stretches, same).select(*kept, number.alias(name))


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of ``df`` starts with one."""
    found = []
    for name in names:
        while any(c.lower().startswith(name) for c in df.columns):
            name += "_"
        found.append(name)
    return found
