"""Deleting, updating and merging rows of Parquet tables, by copying the touched files on write.

The files that hold rows to change are found from their rows' metadata; only
these are rewritten, into a hidden folder of the table, and swapped in at the
end. All other files stay as they are, names included. The swap is written
down before it begins, so one that was cut off is finished by the next change
or by ``recover``. Files that are replaced go to a hidden folder, where
snapshots still find them; ``vacuum`` removes those that no snapshot lists.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.predicates import as_list, conjunction
from millrace.operators.schema import add_missing
from millrace.session import bounded_shares
from millrace.sources.folder import Folder
from millrace.sources.layout import layout_from_properties, with_layout
from millrace.sources.sinks import partitioned_writer
from millrace.sources.tables import partition_columns, quoted, table_properties

#: Hidden folders in a table's folder: new files before the swap, replaced files after it, swaps that are under way.
STAGED, KEPT, SWAPS = "_staged", "_kept", "_swaps"


@dataclass(frozen=True)
class Change:
    """What a statement did: rows deleted or updated, rows inserted, files rewritten."""

    rows: int
    inserted: int
    files: int


def delete_rows(spark: SparkSession, table: str, filters=None, condition: str | Column | None = None) -> Change:
    """Delete the rows that pass the filters and the condition (SQL text or a Column); one of them must be given.

    Rows for which they are NULL stay.
    """
    files = _Files(spark, table)
    hit = files.condition(filters, condition)
    touched = files.touched(files.placed().where(hit))
    files.swap(touched, lambda rows: rows.where(~hit))
    return Change(sum(touched.values()), 0, len(touched))


def update_rows(spark: SparkSession, table: str, values: Mapping[str, object], filters=None, condition: str | Column | None = None) -> Change:
    """Set columns of the rows that pass: ``{column: value, Column, or SQL text marked by F.expr}``.

    New values may use the row's old ones, and are cast to the columns' types.
    Without filters and condition all rows are updated. Rows move to other
    partitions where their values say so.
    """
    files = _Files(spark, table)
    hit = files.condition(filters, condition, everything=True)
    set_ = files.assignments(values)
    touched = files.touched(files.placed().where(hit))
    files.swap(touched, lambda rows: rows.withColumns({c: F.when(hit, v).otherwise(F.col(_tick(c))) for c, v in set_.items()}))
    return Change(sum(touched.values()), 0, len(touched))


def merge_rows(source: DataFrame, table: str, on, matched: str | Mapping[str, object] = "update", unmatched: str = "insert") -> Change:
    """Bring the rows of ``source`` into a table: those whose ``on`` columns equal a row's change it, others are added.

    ``matched`` is ``update`` (all columns that ``source`` has), ``delete``,
    ``keep``, or a mapping of columns to values, in which ``F.col("source.c")``
    and ``F.col("target.c")`` are the two rows. ``unmatched`` is ``insert`` or
    ``skip``; columns that ``source`` lacks are NULL. NULL keys match nothing. A
    row that several rows of ``source`` match is an error.
    """
    if unmatched not in ("insert", "skip") or (isinstance(matched, str) and matched not in ("update", "delete", "keep")):
        raise ValueError(f"matched is update, delete, keep or a mapping, unmatched is insert or skip, not {matched}, {unmatched}")
    spark, keys = source.sparkSession, as_list(on)
    files = _Files(spark, table)
    known = {c.lower() for c in files.columns}
    extra = [c for c in source.columns if c.lower() not in known]
    if extra or not keys:
        raise ValueError(f"{table} has no column {', '.join(extra)}" if extra else "a merge needs columns to match on")
    names = source.select(*[F.col(_tick(c)) for c in keys])
    counts = names.groupBy(*map(_tick, keys)).agg(F.count(F.lit(1)).alias("n"))
    clashing = counts.where("n > 1").join(files.rows(), keys, "left_semi") if matched != "keep" else None
    if clashing is not None and not clashing.isEmpty():
        raise ValueError(f"several rows to merge have the same {', '.join(keys)} as a row of {table}")
    touched = files.touched(files.placed().join(names, keys, "left_semi")) if matched != "keep" else {}
    added = None
    if unmatched == "insert":
        added = source.join(files.rows().select(*map(_tick, keys)), keys, "left_anti")
        types = {f.name: f.dataType for f in files.schema.fields}
        added = add_missing(added, types).select(*[F.col(_tick(c)).cast(types[c]).alias(c) for c in files.columns])

    def merged(rows: DataFrame) -> DataFrame:
        if matched == "delete":
            return rows.join(names, keys, "left_anti")
        rows, given = rows.alias("target"), source.withColumn("#matched", F.lit(True)).alias("source")
        same = reduce(and_, [F.col(f"target.{_tick(k)}") == F.col(f"source.{_tick(k)}") for k in keys])
        own = {c.lower(): c for c in source.columns}
        set_ = {c: F.col(f"source.{_tick(own[c.lower()])}") for c in files.columns if c.lower() in own} if matched == "update" else dict(matched)
        set_ = files.assignments(set_)
        hit = F.coalesce(F.col("source.`#matched`"), F.lit(False))
        joined = rows.join(given, same, "left")
        return joined.select(*[F.when(hit, set_[c]).otherwise(F.col(f"target.{_tick(c)}")).alias(c) if c in set_ else F.col(f"target.{_tick(c)}") for c in files.columns])

    inserted = files.swap(touched, merged, added)
    return Change(sum(touched.values()), inserted, len(touched))


def recover(spark: SparkSession, table: str) -> int:
    """Finish the swaps of a table that were cut off; how many there were."""
    return _Files(spark, table).recovered


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class _Files:
    """A table's files: which of them hold certain rows, and their replacement."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.location = table_location(spark, table)
        self.fs = Folder(spark, self.location)
        self.partitions = partition_columns(spark, table)
        self.layout = layout_from_properties(table_properties(spark, table))
        self.recovered = self._recover()
        self.schema = spark.table(quoted(table)).schema
        self.columns = [c for c in self.schema.names if self.layout is None or c != self.layout.partition]

    def rows(self) -> DataFrame:
        return self.spark.table(quoted(self.table))

    def condition(self, filters, condition, everything: bool = False) -> Column:
        """The predicate of the rows to change; false instead of NULL."""
        parts = [conjunction(self.schema, filters), F.expr(condition) if isinstance(condition, str) else condition]
        parts = [p for p in parts if p is not None]
        if not parts and not everything:
            raise ValueError("a delete needs filters or a condition")
        return F.coalesce(reduce(and_, parts, F.lit(True)), F.lit(False)) if parts else F.lit(True)

    def assignments(self, values: Mapping[str, object]) -> dict[str, Column]:
        types = {f.name.lower(): f for f in self.schema.fields}
        unknown = [c for c in values if c.lower() not in types or c.lower() not in map(str.lower, self.columns)]
        if unknown:
            raise ValueError(f"{self.table} has no column {', '.join(unknown)}")
        return {types[c.lower()].name: (v if isinstance(v, Column) else F.lit(v)).cast(types[c.lower()].dataType) for c, v in values.items()}

    def placed(self) -> DataFrame:
        """All rows with the path and size of the file that they are in, as ``#path`` and ``#size``."""
        return self.rows().select("*", F.col("_metadata.file_path").alias("#path"), F.col("_metadata.file_size").alias("#size"))

    def touched(self, rows: DataFrame) -> dict[str, int]:
        """The files that hold these rows of ``placed``, with how many. As many names reach the driver as files are rewritten."""
        held = {}
        for row in rows.groupBy("#path", "#size").agg(F.count(F.lit(1)).alias("n")).collect():
            path = self.fs.relative(row["#path"])
            self.fs.expect(path, row["#size"])
            held[path] = row["n"]
        return held

    def swap(self, touched: dict[str, int], change, added: DataFrame | None = None) -> int:
        """Rewrite the touched files through ``change``, write ``added`` beside them, and swap; how many rows were added."""
        if not touched and added is None:
            return 0
        name, schema = uuid.uuid4().hex, self.schema
        count = 0
        sizes = {path: self.fs.size(path) for path in touched}
        if touched:
            reader = self.spark.read.schema(schema).option("basePath", self.location)
            rows = change(reader.parquet(*[self.fs.path(p) for p in touched]).select(*[F.col(_tick(c)) for c in schema.names]))
            self._write(rows.select(*[F.col(_tick(c)) for c in self.columns]), f"{STAGED}/{name}/changed")
        if added is not None:
            self._write(added, f"{STAGED}/{name}/added")
            path = self.fs.path(f"{STAGED}/{name}/added")
            count = self.spark.read.schema(schema).parquet(path).count()
        moves = []
        for part in ("changed", "added"):
            for path in self.fs.files(f"{STAGED}/{name}/{part}"):
                moves.append([path, path.split("/", 3)[3]])
        for path, size in sizes.items():  # someone else's change in the meantime would be lost
            self.fs.expect(path, size)
        self._exchange(name, list(touched), moves)
        return count

    def exchange(self, keep: set[str], back: dict[str, str]) -> int:
        """Take out all files but some, and put files back in their places; how many were taken out."""
        gone = [path for path in self.fs.files(suffix=".parquet") if path not in keep]
        self._exchange(uuid.uuid4().hex, gone, [list(m) for m in back.items()])
        return len(gone)

    def _exchange(self, name: str, gone: list[str], moves: list[list[str]]) -> None:
        swap = {"name": name, "kept": [[path, f"{KEPT}/{name}/{path}"] for path in gone], "moves": moves}
        journal = f"{SWAPS}/{name}.json"
        self.fs.write(journal, json.dumps(swap))
        self._finish(journal, swap)

    def _write(self, rows: DataFrame, path: str) -> None:
        if self.layout is not None:
            rows = with_layout(rows, self.layout)
        rows = rows.select(*[F.col(_tick(c)) for c in self.schema.names])
        writer = partitioned_writer(rows, self.partitions) if self.partitions else rows.write
        with bounded_shares(self.spark, bool(self.partitions)):
            writer.parquet(self.fs.path(path))

    def _finish(self, journal: str, swap: dict) -> None:
        """Every step may have been done before."""
        folders = {m[1].rpartition("/")[0] for m in swap["moves"]}
        new = [f for f in folders if f and not self.fs.exists(f)]
        for source, target in [*swap["kept"], *swap["moves"]]:
            self.fs.move(source, target)
        self.fs.delete(journal)
        self.fs.delete(f"{STAGED}/{swap['name']}")
        if self.partitions and (new or self.recovering):
            self.spark.sql(f"MSCK REPAIR TABLE {quoted(self.table)}")
        self.spark.catalog.refreshTable(quoted(self.table))

    recovering = False

    def _recover(self) -> int:
        journals = self.fs.files(SWAPS)
        self.recovering = True
        for journal in journals:
            self._finish(journal, json.loads(self.fs.read(journal)))
        self.recovering = False
        return len(journals)


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a file-backed table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    provider = [row["data_type"].lower() for row in described if row["col_name"] == "Provider"]
    if provider[-1:] != ["parquet"]:
        raise ValueError(f"{table} is no Parquet table")
    # The details follow the columns, so the last row of this name is the folder.
    return [row["data_type"] for row in described if row["col_name"] == "Location"][-1].rstrip("/")
