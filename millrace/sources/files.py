"""Reading files: format by suffix, hive partitions, Parquet, texts and inventories."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.predicates import where, where_file
from millrace.operators.dialects import spark_type, type_of_values
from millrace.operators.relation import limit_rows, project
from millrace.operators.schema import enforce

# File suffix to Spark format.
FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".avro": "avro", ".orc": "orc"}
# Filler column of a dataset partitioned by all of its columns.
FILLER = "__index"
# The columns of the binaryFile source.
BINARY_COLUMNS = ("path", "modificationTime", "length", "content")
_NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def infer_format(path: str) -> str:
    """The format of a file, folder or glob from its suffix; JSON means one document per line."""
    bare = path.rstrip("/*")
    for suffix, name in FORMATS.items():
        if bare.endswith(suffix):
            return name
    raise ValueError(f"cannot tell the format of {path}: expected one of {', '.join(FORMATS)}")


def struct_type(schema) -> T.StructType | None:
    """A StructType from a StructType, DDL text or ``{column: type}``."""
    if schema is None or isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    return spark_type(schema)


@contextmanager
def _partitions_as_text(spark: SparkSession):
    """Within the block, partition values of newly opened paths stay strings (``007`` stays ``007``)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_files(
    spark: SparkSession, path: str, fmt: str | None = None, schema=None, string_partitions: bool = False, **options
) -> DataFrame:
    """The files as they are. Give a schema for CSV and JSON to save the inference scan."""
    fmt = fmt or infer_format(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        reader = reader if schema is not None else reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(struct_type(schema))
    reader = reader.options(**options)
    if string_partitions:
        with _partitions_as_text(spark):
            return reader.load(path)
    return reader.load(path)


def read_files(
    spark: SparkSession, path: str, columns=None, filters=None, schema: dict | None = None,
    limit: int | None = None, fmt: str | None = None, file_schema=None, string_partitions: bool = False,
) -> DataFrame:
    """Filter, project, limit and cast a file read. ``file_schema`` describes the files, ``schema`` the result."""
    df = open_files(spark, path, fmt, file_schema, string_partitions)
    df = limit_rows(project(where(df, filters), columns), limit)
    return enforce(df, schema)


def read_external(spark: SparkSession, path: str, columns=None, filters=None, schema=None, limit=None) -> DataFrame:
    """A hive-partitioned Parquet folder whose partition columns are strings, whatever they look like."""
    return read_files(spark, path, columns, filters, schema, limit, "parquet", string_partitions=True)


def read_parquet(
    spark: SparkSession, path: str, schema=None, filters=None, columns=None, allow_empty: bool = True
) -> DataFrame:
    """A Parquet file or folder. A path without data gives an empty frame of ``schema``.

    ``filters`` may be a list of tuples or a list of such lists (OR of ANDs).
    With ``allow_empty=False`` an empty result is an error.
    """
    expected = struct_type(schema)
    reader = spark.read if expected is None else spark.read.schema(expected)
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NO_DATA:
            raise
        df = spark.createDataFrame([], expected or T.StructType([]))
        filters, columns = (filters, columns) if expected is not None else (None, None)
    df = project(where_file(df, filters), columns)
    if FILLER in df.columns:
        df = df.drop(FILLER)
    if not allow_empty and df.isEmpty():
        raise ValueError(f"{path} is empty or not found, and allow_empty is False")
    return df


def _listed_partitions(listing: DataFrame) -> list[str]:
    return [name for name in listing.columns if name not in BINARY_COLUMNS]


def path_partitions(spark: SparkSession, path: str) -> list[str]:
    """The partition columns in the folder names below ``path``."""
    return _listed_partitions(open_files(spark, path, "binaryFile", string_partitions=True))


def read_partition_values(spark: SparkSession, path: str, schema: dict | None = None) -> DataFrame:
    """The distinct partition values of a hive-partitioned folder, without opening a data file.

    The files are listed as binary files whose content is pruned away, so the
    work grows with the number of files and not of rows. Values are strings
    unless ``schema`` casts them.
    """
    listing = open_files(spark, path, "binaryFile", string_partitions=True)
    keys = _listed_partitions(listing)
    if not keys:
        raise ValueError(f"{path} has no partition folders")
    return enforce(listing.select(*keys).distinct(), schema)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``, one row per object, each with its whole text; partition columns follow."""
    texts = spark.read.text(path, wholetext=True)
    keys = [name for name in texts.columns if name != "value"]
    return texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), *keys)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime)`` of the files under a folder whose names match a glob."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", recursive).load(path).select("path", "length", "modificationTime")


def list_folder(inventory: DataFrame, root: str) -> DataFrame:
    """``(name, is_dir, num_bytes)``: the entries directly under ``root``, from an inventory below it."""
    prefix = root.rstrip("/") + "/"
    inside = inventory.where(F.col("path").contains(prefix))
    rest = F.substring("path", F.instr("path", F.lit(prefix)) + len(prefix), F.length("path"))
    entries = inside.select(F.substring_index(rest, "/", 1).alias("name"), rest.contains("/").alias("is_dir"), "length")
    return entries.groupBy("name", "is_dir").agg(F.sum("length").alias("num_bytes"))


def walk_folders(inventory: DataFrame, root: str) -> DataFrame:
    """``(path, name, depth, is_dir, num_files, num_bytes)``: all that is below ``root``, at every level, and ``root`` itself.

    ``path`` is relative, empty for the root. A folder has the files and bytes
    of all that is below it. Every file counts once for each of its folders;
    tasks add up before anything is shuffled, so the root is no hot key.
    """
    prefix = root.rstrip("/") + "/"
    inside = inventory.where(F.col("path").contains(prefix))
    rest = F.substr("path", F.instr("path", F.lit(prefix)) + len(prefix))
    parts = inside.select(F.split(rest, "/").alias("parts"), "length")
    levels = parts.select(F.posexplode(F.transform(F.sequence(F.lit(0), F.size("parts")), lambda n: F.array_join(F.slice("parts", F.lit(1), n), "/"))).alias("depth", "path"), "parts", "length")
    is_dir = F.col("depth") < F.size("parts")
    rolled = levels.groupBy("path", "depth", is_dir.alias("is_dir")).agg(F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("num_bytes"))
    return rolled.select("path", F.substring_index("path", "/", -1).alias("name"), "depth", "is_dir", "num_files", "num_bytes")


def glob_pattern(pattern: str) -> str:
    """A regular expression for a glob: ``*`` and ``?`` stay within a name, ``**`` goes over any number of folders."""
    found, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        end = pattern.find("]", at + 2) if c == "[" else -1
        if pattern.startswith("**/", at):
            found.append("(?:[^/]+/)*")
            at += 2
        elif pattern.startswith("**", at):
            found.append(".*")
            at += 1
        elif end > 0:
            found.append(f"[{'^/' if pattern[at + 1] in '!^' else ''}{re.sub(r'([\\[&~^])', chr(92) * 2 + '1', pattern[at + 1:end].lstrip('!^'))}]")
            at = end
        else:
            found.append({"*": "[^/]*", "?": "[^/]"}.get(c) or (c if c.isalnum() else "\\" + c))
        at += 1
    return "^" + "".join(found) + "$"


def glob_paths(df: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """The rows whose path, relative as ``walk_folders`` gives it, matches a glob."""
    return df.where(F.col(path).rlike(glob_pattern(pattern)))


def ingest_rows(spark: SparkSession, data, schema=None) -> DataFrame:
    """Rows the caller holds: a dict of columns, one dict, a list of dicts or a pandas frame."""
    expected = struct_type(schema)
    if hasattr(data, "iloc"):  # a pandas frame
        return spark.createDataFrame(data, expected) if expected is not None else spark.createDataFrame(data)
    if isinstance(data, dict):
        lists = {name: list(v) if isinstance(v, (list, tuple)) else [v] for name, v in data.items()}
        if len({len(values) for values in lists.values()}) > 1:
            raise ValueError("columns of unequal length")
        data = [dict(zip(lists, row)) for row in zip(*lists.values())]
    if expected is None:
        names = list(dict.fromkeys(name for row in data for name in row))
        fields = [(name, type_of_values([row.get(name) for row in data])) for name in names]
        expected = T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])
    whole = [f.name for f in expected.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    data = [{**row, **{n: float(row[n]) for n in whole if isinstance(row.get(n), int)}} for row in data if isinstance(row, dict)] or data
    return spark.createDataFrame(data, expected)
