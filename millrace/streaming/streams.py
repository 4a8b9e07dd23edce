"""Tailing a log, and routing a stream of messages to tables, files and topics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.names import unused
from millrace.operators.logs import log_conditions
from millrace.operators.relation import project
from millrace.sources.files import struct_type
from millrace.sources.sinks import messages
from millrace.sources.tables import ensure_database, quoted, read_table

# The poll interval and the allowance for late entries of a tail.
POLL_INTERVAL = "5 seconds"
LATENCY = "10 seconds"


def open_stream(
    spark: SparkSession, path: str | None = None, schema=None, fmt: str = "parquet",
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """New files under ``path`` as a stream. A path pattern may name files as well as folders.

    Files need a schema; sources with one of their own, such as a topic, take options only.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(struct_type(schema))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def tail(stream: DataFrame, query=None, severity=None, time_start: dt.datetime | None = None,
         time: str = "timestamp", level: str = "severity") -> DataFrame:
    """Entries from ``time_start`` on that match. No state is kept, so late entries come through."""
    start = time_start or dt.datetime.now(dt.timezone.utc)
    for condition in log_conditions(stream, query, severity, start, time=time, level=level):
        stream = stream.where(condition)
    return stream


def tail_strict(stream: DataFrame, row_id: str, time: str = "timestamp", *, delay: str) -> DataFrame:
    """Each entry once by its id, and entries later than ``delay`` left out.

    This keeps the ids of the last ``delay`` as state. Use it only where late
    entries must not come through; ``tail`` is whole and needs no state, and
    ``split_late`` keeps late entries aside.
    """
    if isinstance(stream.schema[time].dataType, T.TimestampType):
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([row_id])
    event_time = unused(stream, "_event_time")[0]
    marked = stream.withColumn(event_time, F.col(time).cast("timestamp"))
    return marked.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([row_id]).drop(event_time)


#: Folders that ``split_late`` writes below its path, and the one where it keeps each batch's latest time.
ON_TIME, LATE, MARKS = "on_time", "late", "marks"


def split_late(stream: DataFrame, row_id: str, path: str, checkpoint: str, time: str = "timestamp", *, delay: str,
               once: bool = False, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Each entry once by its id to ``path/on_time``, and late ones to ``path/late``; none vanish.

    Late is what is older than the latest time of all earlier batches less
    ``delay``. Entries without a time are on time. An entry on time whose id was
    delivered with a time within the delay is a repetition and left out; late
    entries are all kept, repetitions among them too. A batch writes a folder of
    its own (``batch=7``), anew if it runs again, so a restart repeats nothing.
    Only the delivered ids of the last ``delay`` are read again.
    """
    moment = F.col(time).cast("timestamp")

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = _batches(spark, f"{path}/{MARKS}", "latest timestamp", number)
        latest = marks.agg(F.max("latest")).first()[0] if marks is not None else None
        bound = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        is_late = F.coalesce(moment < bound, F.lit(False))
        _write_batch(batch.where(is_late), f"{path}/{LATE}", number)
        fresh = batch.where(~is_late).dropDuplicates([row_id])
        delivered = _batches(spark, f"{path}/{ON_TIME}", batch.schema, number)
        if delivered is not None:
            recent = delivered.where(moment.isNull() | F.coalesce(moment >= bound, F.lit(True)))
            fresh = fresh.join(recent.select(row_id).distinct(), row_id, "left_anti").select(batch.columns)
        _write_batch(fresh, f"{path}/{ON_TIME}", number)
        _write_batch(batch.agg(F.max(moment).alias("latest")), f"{path}/{MARKS}", number)

    return _writer(stream, checkpoint, once, interval).foreachBatch(deliver).start()


def _write_batch(rows: DataFrame, folder: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/batch={number}")


def _batches(spark: SparkSession, folder: str, schema, before: int) -> DataFrame | None:
    """The rows of the batches written before this one; None for the first."""
    if before == 0:
        return None
    kept = struct_type(schema) if not isinstance(schema, (str, T.StructType)) else schema
    batch = "batch"
    frame = spark.read.schema(kept).parquet(f"{folder}/{batch}=*")
    number = F.regexp_extract(F.col("_metadata.file_path"), f"/{batch}=([0-9]+)/[^/]*$", 1).cast("long")
    return frame.where(number < before)


class Windows(DataSource):
    """A stream of time windows: each begins where the last ended and ends ``latency`` before now.

    The offset is the end of the last window, so a checkpoint goes on from
    there. Options: ``start`` (ISO, UTC; now by default), ``latency`` (seconds)
    and ``until``, the end of the last window.
    """

    @classmethod
    def name(cls) -> str:
        return "millrace_windows"

    def schema(self) -> str:
        return "window_start string, window_end string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _WindowReader(self.options)


def _utc(moment: dt.datetime) -> str:
    """A time as text that sorts as times do; one without a zone is in UTC."""
    moment = moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)
    return moment.isoformat(timespec="microseconds")


class _WindowReader(DataSourceStreamReader):
    def __init__(self, options):
        self.start, self.until = options.get("start"), options.get("until")
        self.latency = dt.timedelta(seconds=float(options.get("latency", LATENCY.split()[0])))
        self.floor = ""

    def initialOffset(self) -> dict:
        # Asked for by a stream without a checkpoint only: a restarted one isn't held back by its start.
        self.floor = self.start or _utc(dt.datetime.now(dt.timezone.utc))
        return {"end": self.floor}

    def latestOffset(self) -> dict:
        end = _utc(dt.datetime.now(dt.timezone.utc) - self.latency)
        return {"end": max(min(end, self.until) if self.until else end, self.floor)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["end"] < start["end"]:
            raise ValueError(f"the clock, or the end asked for, went back from {start['end']} to {end['end']}")
        return [InputPartition((start["end"], end["end"]))]

    def read(self, partition: InputPartition):
        yield partition.value


def poll_table(spark: SparkSession, table: str, path: str, checkpoint: str, query=None, severity=None,
               time_start: dt.datetime | None = None, time_end: dt.datetime | None = None, time: str = "timestamp",
               level: str = "severity", columns=None, latency: str = LATENCY, once: bool = False, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Entries of a growing table that match, window by window, to ``path``, each batch in a folder of its own.

    A poll reads the entries from the end of the last window on and before
    ``latency`` ago, so those that arrive up to that late come through. Filters
    reach the table's scan and prune its days. A poll that was cut off is done
    again in place; a restart goes on with the next window. ``time_start`` is now
    by default, ``time_end`` the end of the last window.
    """
    spark.dataSource.register(Windows)
    given = {"start": time_start, "until": time_end}
    seconds = str(dt.timedelta(**{latency.split()[1].rstrip("s") + "s": float(latency.split()[0])}).total_seconds())
    clock = spark.readStream.format(Windows.name()).options(**{k: _utc(v) for k, v in given.items() if v is not None}, latency=seconds).load()

    def poll(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        session.catalog.refreshTable(quoted(table))
        zoned = isinstance(session.table(quoted(table)).schema[time].dataType, T.TimestampType)
        for window in batch.collect():  # one row
            start, end = (dt.datetime.fromisoformat(w) if zoned else dt.datetime.fromisoformat(w).replace(tzinfo=None) for w in window)
            entries = read_table(session, table, filters=[(time, ">=", start), (time, "<", end)])
            for condition in log_conditions(entries, query, severity, None, time=time, level=level):
                entries = entries.where(condition)
            _write_batch(project(entries, columns), path, number)

    return _writer(clock, checkpoint, once, interval).foreachBatch(poll).start()


def subscribe(stream: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """The messages a subscription delivers: those that pass its filter expression."""
    if condition is None:
        return stream
    return stream.where(F.expr(condition) if isinstance(condition, str) else condition)


def _writer(stream: DataFrame, checkpoint: str, once: bool, interval: str):
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def to_files(stream: DataFrame, path: str | None, checkpoint: str, fmt: str = "json", once: bool = False, interval: str = POLL_INTERVAL, **options) -> StreamingQuery:
    """The stream appended to files, each row exactly once."""
    return _writer(stream, checkpoint, once, interval).format(fmt).options(**options).start(path)


def to_table(stream: DataFrame, table: str, checkpoint: str, once: bool = False, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """The stream appended to a table, which is created when missing."""
    ensure_database(stream.sparkSession, table)
    return _writer(stream, checkpoint, once, interval).format("parquet").toTable(quoted(table))


def publish_stream(stream: DataFrame, target: str | None, checkpoint: str, columns=None, payload=None,
                   fmt: str = "text", once: bool = False, interval: str = POLL_INTERVAL, **options) -> StreamingQuery:
    """Rows as messages to a text folder, or to any streaming sink that takes a ``value`` column."""
    return to_files(messages(stream, columns, payload), target, checkpoint, fmt, once, interval, **options)
