"""Streams over the events, run to the end of what is there."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.plans.registry import query, scratch_database, table
from millrace.session import scratch_path
from millrace.sources import files, tables
from millrace.streaming import streams


def event_stream(spark, sf_dir):
    """The events as a stream; the pattern matches one file as well as a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    return streams.open_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def entry_stream(spark, sf_dir):
    return event_stream(spark, sf_dir).select(
        "event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("severity"), F.col("props").alias("message")
    )


def _finish(stream, spark, fmt="parquet"):
    path = scratch_path(spark, f"stream.{fmt}")
    streams.to_files(stream, path, scratch_path(spark, "checkpoint"), fmt, once=True).awaitTermination()
    return files.open_files(spark, path, fmt, schema=stream.schema)


@query(
    "str_01_tail",
    "SELECT event_id, ts AS timestamp, event_type AS severity, props AS message FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10'",
)
def tail(spark, sf_dir):
    stream = streams.tail(entry_stream(spark, sf_dir), severity="error", time_start=dt.datetime(2024, 1, 10))
    return _finish(stream, spark)


@query("str_02_tail_strict", "SELECT event_id, ts, user_id FROM events")
def tail_strict(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select("event_id", "ts", "user_id")
    return _finish(streams.tail_strict(stream, "event_id", "ts", delay=streams.LATENCY), spark)


@query(
    "str_01_poll_table",
    """SELECT event_id, ts AS timestamp, event_type AS severity, props AS message FROM events
       WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""",
)
def poll_table(spark, sf_dir):
    name, path = f"{scratch_database(spark)}.entries", scratch_path(spark, "polled")
    entries = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("severity"), F.col("props").alias("message"))
    tables.write_table(entries, name, time_partition="timestamp")
    checkpoint, start = scratch_path(spark, "checkpoint"), dt.datetime(2024, 1, 10)
    for end in (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 20)):
        streams.poll_table(spark, name, path, checkpoint, severity="error", time_start=start, time_end=end, once=True).awaitTermination()
    return spark.read.schema(entries.schema).parquet(f"{path}/batch=*")


@query("str_02_late_rows", "SELECT event_id, ts, user_id, ts < TIMESTAMP '2024-01-10' AS late FROM events")
def late_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    folder, path, cut = scratch_path(spark, "arriving"), scratch_path(spark, "split"), F.lit(dt.datetime(2024, 1, 10))
    # The first days arrive last.
    for part in (events.where(F.col("ts") >= cut), events.where(F.col("ts") < cut)):
        part.write.mode("append").parquet(folder)
        stream = streams.open_stream(spark, folder, events.schema)
        streams.split_late(stream, "event_id", path, f"{path}/checkpoint", "ts", delay=streams.LATENCY, once=True).awaitTermination()
    sides = [spark.read.schema(events.schema).parquet(f"{path}/{side}/batch=*").withColumn("late", F.lit(side == streams.LATE)) for side in (streams.ON_TIME, streams.LATE)]
    return sides[0].union(sides[1])


@query("str_03_subscription_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'signup' AND value > 3.0")
def subscription_filter(spark, sf_dir):
    stream = streams.subscribe(event_stream(spark, sf_dir), "event_type = 'signup' AND value > 3.0")
    return _finish(stream.select("event_id", "user_id", "value"), spark)


@query("str_04_to_table", "SELECT event_id, event_type, value FROM events")
def to_table(spark, sf_dir):
    name = f"{scratch_database(spark)}.events"
    stream = event_stream(spark, sf_dir).select("event_id", "event_type", "value")
    streams.to_table(stream, name, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return spark.table(name)


@query("str_05_to_files", "SELECT event_id, event_type, value FROM events")
def to_files(spark, sf_dir):
    return _finish(event_stream(spark, sf_dir).select("event_id", "event_type", "value"), spark, "json")


@query("str_06_publish_stream", "SELECT event_id, user_id, props FROM events")
def publish_stream(spark, sf_dir):
    path = scratch_path(spark, "topic")
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", "props")
    streams.publish_stream(stream, path, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.text(path).select(F.from_json("value", stream.schema).alias("m")).select("m.*")
