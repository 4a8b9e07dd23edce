"""Writing files and messages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.predicates import as_list
from millrace.functions.text import json_payload
from millrace.operators.relation import project
from millrace.operators.schema import enforce, storable
from millrace.session import bounded_shares
from millrace.sources.files import FILLER
from millrace.sources.folder import Folder
from millrace.sources.layout import clustered


def partitioned_writer(df: DataFrame, partition_by: list[str], cluster_by: list[str] | None = None):
    """A writer whose tasks each hold few partitions.

    Without cluster columns the rows are rebalanced by the partition columns:
    AQE merges small partitions and splits hot ones over several tasks; write
    within ``bounded_shares``, which bounds these tasks' memory.
    """
    if cluster_by:
        return clustered(df, cluster_by, partition_by).write.partitionBy(*partition_by)
    return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)


def write_parquet(
    df: DataFrame, path: str, partition_by=None, schema: dict | None = None, cluster_by=None, mode: str = "errorifexists",
    basename: str | None = None,
) -> None:
    """A Parquet folder, hive-partitioned when ``partition_by`` is given.

    Spark needs a data column, so when all columns are partition columns a
    filler column is added, which reading takes out again. ``basename``, such
    as ``{i}.parquet``, names the files by their number in their folder, once
    all are written.
    """
    if basename is not None:
        _checked(basename)
    df = storable(enforce(df, schema))
    if not partition_by:
        with bounded_shares(df.sparkSession, bool(cluster_by)):
            (clustered(df, cluster_by) if cluster_by else df).write.mode(mode).parquet(path)
        if basename is not None:
            name_files(df.sparkSession, path, basename)
        return
    keys = as_list(partition_by)
    if set(keys) == set(df.columns):
        df = df.withColumn(FILLER, F.lit(0).cast("bigint"))
    with bounded_shares(df.sparkSession):
        partitioned_writer(df, keys, cluster_by).mode(mode).parquet(path)
    if basename is not None:
        name_files(df.sparkSession, path, basename)


def _checked(basename: str) -> None:
    if "/" in basename or basename.startswith(("_", ".")) or basename.format(i=0) == basename.format(i=1):
        raise ValueError(f"not a template of file names: {basename}")


def name_files(spark: SparkSession, path: str, basename: str) -> int:
    """Name the files that Spark wrote below a folder after a template with their number ``{i}``; how many there were.

    Files number on from those that have such names in their folder, in the
    order of their tasks. Files with other names than Spark's stay, so this can
    be run again after it was cut off.
    """
    _checked(basename)
    folder = Folder(spark, path)
    found: dict[str, list[str]] = {}
    for file in folder.files():
        at, _, name = file.rpartition("/")
        found.setdefault(at, []).append(name)
    renamed = 0
    for at, names in found.items():
        held, i = set(names), 0
        for name in sorted(n for n in names if re.match("part-[0-9]{5}-[0-9a-f-]{36}", n)):
            while basename.format(i=i) in held:
                i += 1
            held.add(basename.format(i=i))
            folder.move(f"{at}/{name}".lstrip("/"), f"{at}/{basename.format(i=i)}".lstrip("/"))
            renamed += 1
    return renamed


def messages(df: DataFrame, columns=None, payload: str | Column | None = None) -> DataFrame:
    """One ``value`` text per row: a column as it is, or the row as JSON."""
    if payload is not None:
        column = F.col(payload) if isinstance(payload, str) else payload
        return df.select(column.cast("string").alias("value"))
    names = project(df, columns).columns
    return df.select(json_payload(*[F.col(f"`{n}`") for n in names]).alias("value"))


def publish(df: DataFrame, target: str | None = None, columns=None, payload=None, fmt: str = "text", mode: str = "append", **options) -> None:
    """Rows as messages to a text folder, or to any sink that takes a ``value`` column (a topic needs no target)."""
    messages(df, columns, payload).write.format(fmt).mode(mode).options(**options).save(target)


def write_texts(df: DataFrame, path: str, text: str, one_object_per=None, mode: str = "errorifexists") -> None:
    """Texts as text files, in one folder per value of ``one_object_per`` when given."""
    keys = as_list(one_object_per) if one_object_per else []
    frame = df.select(F.col(text).alias("value"), *keys)
    writer = partitioned_writer(frame, keys) if keys else frame.write
    with bounded_shares(df.sparkSession, bool(keys)):
        writer.mode(mode).text(path)
