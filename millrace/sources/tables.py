"""Catalog tables: reading, creating, appending, replacing, copying and extending them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.predicates import as_list, where
from millrace.operators.relation import limit_rows, project
from millrace.operators.schema import add_missing, enforce, storable
from millrace.functions.names import url_decode
from millrace.session import bounded_shares
from millrace.sources.files import file_inventory, infer_format, open_files, path_partitions, struct_type
from millrace.sources.layout import (
    RangePartition,
    TimePartition,
    clustered,
    layout_from_properties,
    layout_properties,
    prune,
    with_layout,
)
from millrace.sources.sinks import partitioned_writer

# Table property that lists the columns a table was clustered by.
CLUSTER_PROPERTY = "millrace.cluster_by"
# What catalogs themselves note down as properties.
CATALOG_PROPERTIES = {
    "COLUMN_STATS_ACCURATE", "EXTERNAL", "bucketing_version", "numFiles", "numFilesErasureCoded", "numRows", "owner",
    "rawDataSize", "totalSize", "transient_lastDdlTime",
}
# Fixed value: the folder name of a NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def quoted(name: str) -> str:
    """A dotted name with each part in backticks."""
    parts = [part.strip("`") for part in name.split(".")]
    if not 1 <= len(parts) <= 3 or any(not part or "`" in part for part in parts):
        raise ValueError(f"not a table name: {name}")
    return ".".join(f"`{part}`" for part in parts)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(quoted(table)) if column.isPartition]


def ensure_database(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the database that ``table`` names, when it is missing."""
    parts = quoted(table).split(".")
    if len(parts) > 1:
        where_to = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {'.'.join(parts[:-1])}{where_to}")


def read_table(
    spark: SparkSession, table: str, columns=None, filters=None, schema: dict | None = None, limit: int | None = None
) -> DataFrame:
    """Filter, project, limit and cast a table.

    For a table written with a time or range partition, filters on the source
    column also prune partitions; the derived column is left out of the result.
    """
    df = spark.table(quoted(table))
    layout = layout_from_properties(table_properties(spark, table))
    if layout is not None:
        df = prune(df, layout, filters)
    df = where(df, filters)
    if layout is not None and (columns is None or layout.partition not in as_list(columns)):
        df = df.drop(layout.partition) if columns is None or "*" in as_list(columns) else df
    return enforce(limit_rows(project(df, columns), limit), schema)


def create_external(
    spark: SparkSession, table: str, path: str, schema=None, exists_ok: bool = True, string_partitions: bool = True
) -> DataFrame:
    """A table over existing files; the format comes from the suffix, a given schema is honoured.

    Dropping the table leaves the files. Partition columns become strings
    unless ``string_partitions`` is off. A table that exists is left as it is,
    or is an error without ``exists_ok``.
    """
    ensure_database(spark, table)
    if exists_ok and spark.catalog.tableExists(quoted(table)):
        return spark.table(quoted(table))
    fmt = infer_format(path)
    options = {"header": "true"} if fmt == "csv" else {}
    shape = open_files(spark, path, fmt, schema, string_partitions).schema
    keys = [name for name in path_partitions(spark, path) if name in shape.names]
    if not keys:
        return spark.catalog.createTable(quoted(table), path=path, source=fmt, schema=shape, **options)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.fields)
    settings = ", ".join(f"'{k}'='{v}'" for k, v in {**options, "path": path}.items())
    by = ", ".join(f"`{name}`" for name in keys)
    spark.sql(f"CREATE TABLE {quoted(table)} ({columns}) USING {fmt} OPTIONS ({settings}) PARTITIONED BY ({by})")
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")
    return spark.table(quoted(table))


def insert(df: DataFrame, table: str, schema: dict | None = None, cluster_by=None) -> None:
    """Append to an existing table, columns matched by name; columns that ``df`` lacks are NULL.

    ``cluster_by`` clusters the appended rows within the table's partitions.
    """
    spark = df.sparkSession
    target = spark.table(quoted(table))
    df = enforce(df, schema)
    layout = layout_from_properties(table_properties(spark, table))
    if layout is not None and layout.partition not in df.columns:
        df = with_layout(df, layout)
    known = {name.lower() for name in target.columns}
    extra = [name for name in df.columns if name.lower() not in known]
    if extra:
        raise ValueError(f"{table} has no column {', '.join(extra)}")
    rows = add_missing(df, {f.name: f.dataType for f in target.schema.fields}).select(target.columns)
    partitions = partition_columns(spark, table)
    if cluster_by:
        rows = clustered(rows, as_list(cluster_by), partitions)
    elif partitions:
        rows = rows.hint("rebalance", *partitions)
    with bounded_shares(spark, bool(cluster_by or partitions)):
        spark.sql(f"INSERT INTO {quoted(table)} BY NAME SELECT * FROM {{rows}}", rows=rows)


def _refuse_other_layout(spark: SparkSession, table: str, layout, partitions: list[str]) -> None:
    """Raise if a partitioning is asked for that an existing table doesn't have."""
    own = layout_from_properties(table_properties(spark, table))
    plain = [c.lower() for c in partition_columns(spark, table) if own is None or c != own.partition]
    if layout is not None and layout != own:
        raise ValueError(f"{table} has another time or range partitioning: {own}")
    if partitions and [c.lower() for c in partitions] != plain:
        raise ValueError(f"{table} is partitioned by {plain}, not {partitions}")


def write_table(
    df: DataFrame, table: str, if_exists: str = "append", schema: dict | None = None,
    time_partition: str | None = None, range_partition: RangePartition | None = None,
    cluster_by=None, partition_by=None,
) -> None:
    """Create a table from ``df``, or append to, replace or refuse an existing one.

    ``if_exists`` is ``append``, ``replace`` or ``fail``. Time partitioning is
    by day; it excludes range partitioning. Appending with a partitioning that the
    table doesn't have raises; ``cluster_by`` then clusters the appended rows.
    """
    if if_exists not in ("append", "replace", "fail"):
        raise ValueError(f"if_exists must be append, replace or fail, not {if_exists}")
    if time_partition and range_partition:
        raise ValueError("a table has either time or range partitioning")
    spark = df.sparkSession
    layout = TimePartition(time_partition) if time_partition else range_partition
    partitions, cluster = as_list(partition_by) if partition_by else [], as_list(cluster_by) if cluster_by else []
    ensure_database(spark, table)
    if if_exists == "append" and spark.catalog.tableExists(quoted(table)):
        _refuse_other_layout(spark, table, layout, partitions)
        insert(df, table, schema, cluster)
        return
    df = storable(enforce(df, schema))
    if layout is not None:
        df = with_layout(df, layout)
        partitions = [*partitions, layout.partition]
    if partitions:
        writer = partitioned_writer(df, partitions, cluster)
    else:
        writer = (clustered(df, cluster) if cluster else df).write
    mode = "overwrite" if if_exists == "replace" else "errorifexists"
    with bounded_shares(spark, bool(partitions or cluster)):
        writer.format("parquet").mode(mode).saveAsTable(quoted(table))
    noted = layout_properties(layout) if layout is not None else {}
    if cluster:
        noted[CLUSTER_PROPERTY] = json.dumps(cluster)
    set_properties(spark, table, noted)


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    """Set properties of a table; others stay as they are."""
    if properties:
        texts = [[part.replace("\\", "\\\\").replace("'", "\\'") for part in pair] for pair in properties.items()]
        pairs = ", ".join(f"'{k}'='{v}'" for k, v in texts)
        spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({pairs})")


def create_table(
    spark: SparkSession, table: str, schema, rows: DataFrame | None = None, exists_ok: bool = True, **layout
) -> None:
    """An empty table of the given schema, its database made when missing; then ``rows`` are inserted.

    A table that exists is kept and inserted into, or is an error without ``exists_ok``.
    """
    if not (exists_ok and spark.catalog.tableExists(quoted(table))):
        write_table(spark.createDataFrame([], struct_type(schema)), table, "fail", **layout)
    if rows is not None:
        insert(rows, table)


def copy_table(spark: SparkSession, source: str, target: str, if_exists: str = "replace") -> None:
    """A copy with the same partition and cluster columns and properties; an existing target is replaced or an error."""
    if quoted(source).lower() == quoted(target).lower():
        raise ValueError("a table cannot be copied onto itself")
    if if_exists != "replace" and spark.catalog.tableExists(quoted(target)):
        raise ValueError(f"table already exists: {target}")
    properties = {k: v for k, v in table_properties(spark, source).items() if k not in CATALOG_PROPERTIES}
    cluster = json.loads(properties.get(CLUSTER_PROPERTY, "[]"))
    partitions = partition_columns(spark, source)
    write_table(spark.table(quoted(source)), target, "replace", partition_by=partitions or None, cluster_by=cluster or None)
    set_properties(spark, target, properties)


def copy_database(spark: SparkSession, source: str, target: str, if_exists: str = "replace") -> list[str]:
    """Copies every table of a database; the names of the copies."""
    names = [t.name for t in spark.catalog.listTables(source) if not t.isTemporary and t.tableType != "VIEW"]
    for name in names:
        copy_table(spark, f"{source}.{name}", f"{target}.{name}", if_exists)
    return names


def add_columns(spark: SparkSession, table: str, columns: dict) -> None:
    """Add the columns that ``table`` lacks; they stand before any partition columns."""
    have = {name.lower() for name in spark.table(quoted(table)).columns}
    new = [f for f in struct_type(columns).fields if f.name.lower() not in have]
    if new:
        parts = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({parts})")


def table_partitions(spark: SparkSession, table: str) -> DataFrame:
    """The partition values of a table as columns, from the catalog alone."""
    keys = partition_columns(spark, table)
    types = {f.name: f.dataType for f in spark.table(quoted(table)).schema.fields}
    listed = spark.sql(f"SHOW PARTITIONS {quoted(table)}")
    parts = F.split("partition", "/")
    values = [F.nullif(F.substring_index(parts[i], "=", -1), F.lit(NULL_PARTITION)) for i in range(len(keys))]
    return listed.select(*[url_decode(v).cast(types[k]).alias(k) for v, k in zip(values, keys)])


def table_stats(spark: SparkSession, table: str) -> DataFrame:
    """``(table_name, num_rows, num_bytes)`` of a file-backed table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    # The details follow the columns, so the last row of this name is the folder.
    location = [row["data_type"] for row in described if row["col_name"] == "Location"][-1]
    nothing = F.lit(None).cast("bigint")
    rows = spark.table(quoted(table)).agg(F.count(F.lit(1)).alias("num_rows"), F.max(nothing).alias("num_bytes"))
    size = file_inventory(spark, location).agg(F.max(nothing).alias("num_rows"), F.sum("length").alias("num_bytes"))
    both = rows.unionByName(size).agg(F.max("num_rows").alias("num_rows"), F.max("num_bytes").alias("num_bytes"))
    return both.select(F.lit(table).alias("table_name"), "num_rows", "num_bytes")
