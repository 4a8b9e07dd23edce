import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.streaming import streams as S

SCHEMA = "id bigint, timestamp timestamp_ntz, severity string, message string"


@pytest.fixture
def log_files(spark, scratch):
    """Three files whose times come in no order, one row on every second."""
    folder = scratch("log")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    entries = spark.range(600).select(
        "id", (start + F.make_dt_interval(secs=F.col("id"))).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "error").otherwise("info").alias("severity"),
        F.concat(F.lit("m"), "id").alias("message"),
    )
    for low, high in [(200, 400), (400, 600), (0, 200)]:
        entries.where(F.col("id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(folder)
    return folder, entries


def finish(spark, stream, scratch, fmt="parquet"):
    path = scratch("out")
    S.to_files(stream, path, scratch("checkpoint"), fmt, once=True).awaitTermination()
    return spark.read.schema(stream.schema).format(fmt).load(path)


def test_tail_keeps_late_rows_and_both_bounds(spark, log_files, scratch):
    folder, entries = log_files
    stream = S.open_stream(spark, folder, SCHEMA, files_per_batch=1)
    start = dt.datetime(2024, 1, 1, 0, 1, 40)
    out = finish(spark, S.tail(stream, severity="error", time_start=start), scratch)
    assert rows(out) == rows(entries.where("id >= 100 and severity = 'error'"))
    query = S.tail(stream, query="message like 'm59%'", time_start=dt.datetime(2024, 1, 1))
    assert rows(finish(spark, query, scratch).select("id")) == rows(entries.where("message like 'm59%'").select("id"))


def test_tail_starts_now_by_default(spark, log_files, scratch):
    assert finish(spark, S.tail(S.open_stream(spark, log_files[0], SCHEMA)), scratch).isEmpty()


def test_strict_tail_drops_duplicates_and_late_rows(spark, log_files, scratch):
    folder, entries = log_files
    entries.coalesce(1).write.mode("append").parquet(folder)  # every row again
    one_batch = finish(spark, S.tail_strict(S.open_stream(spark, folder, SCHEMA), "id", delay=S.LATENCY), scratch)
    assert rows(one_batch) == rows(entries)
    batches = S.tail_strict(S.open_stream(spark, folder, SCHEMA, files_per_batch=1), "id", delay=S.LATENCY)
    found = [r["id"] for r in finish(spark, batches, scratch).collect()]
    assert len(found) == len(set(found)) < 600
    patient = S.tail_strict(S.open_stream(spark, folder, SCHEMA, files_per_batch=1), "id", delay="1 day")
    assert rows(finish(spark, patient, scratch)) == rows(entries)


def test_a_restarted_stream_goes_on_where_it_stopped(spark, pairs, scratch, database):
    folder, checkpoint, name = scratch("in"), scratch("checkpoint"), f"{database}.t"
    for _ in range(2):
        pairs.write.mode("append").parquet(folder)
        stream = S.open_stream(spark, folder, "a bigint, b bigint")
        S.to_table(stream, name, checkpoint, once=True).awaitTermination()
    assert rows(spark.table(name)) == sorted(rows(pairs) * 2)


def test_subscriptions_and_topics(spark, pairs, scratch):
    folder = scratch("in")
    pairs.write.parquet(folder)
    stream = S.open_stream(spark, folder, "a bigint, b bigint")
    assert rows(finish(spark, S.subscribe(stream, "a > 1"), scratch, "json")) == [(2, 5), (3, 6)]
    assert rows(finish(spark, S.subscribe(stream, F.col("b") == 4), scratch)) == [(1, 4)]
    assert rows(finish(spark, S.subscribe(stream), scratch)) == rows(pairs)
    topic = scratch("topic")
    S.publish_stream(stream, topic, scratch("checkpoint"), once=True).awaitTermination()
    assert rows(spark.read.text(topic)) == [('{"a":1,"b":4}',), ('{"a":2,"b":5}',), ('{"a":3,"b":6}',)]


def test_a_running_stream_polls_for_new_files(spark, pairs, scratch):
    folder, out = scratch("in"), scratch("out")
    pairs.write.parquet(folder)
    query = S.to_files(S.open_stream(spark, folder, "a bigint, b bigint"), out, scratch("checkpoint"), "parquet", interval="1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(out).count() == 3
        pairs.write.mode("append").parquet(folder)
        query.processAllAvailable()
        assert spark.read.parquet(out).count() == 6
    finally:
        query.stop()


def test_sources_with_a_schema_of_their_own(spark):
    assert S.open_stream(spark, fmt="rate", rowsPerSecond=1).columns == ["timestamp", "value"]


def test_late_rows_go_to_a_sink_of_their_own(spark, log_files, scratch):
    folder, entries = log_files
    path, checkpoint = scratch("split"), scratch("checkpoint")

    def run():
        stream = S.open_stream(spark, folder, SCHEMA, files_per_batch=1)
        S.split_late(stream, "id", path, checkpoint, delay=S.LATENCY, once=True).awaitTermination()

    run()
    on_time, late = (spark.read.schema(SCHEMA).parquet(f"{path}/{name}/batch=*") for name in (S.ON_TIME, S.LATE))
    assert rows(on_time.union(late)) == rows(entries)
    assert rows(late) == rows(entries.where("id < 200"))  # the last file is older than all before
    entries.where("id >= 595").coalesce(1).write.mode("append").parquet(folder)  # again, within the delay
    run()
    on_time, late = (spark.read.schema(SCHEMA).parquet(f"{path}/{name}/batch=*") for name in (S.ON_TIME, S.LATE))
    assert rows(on_time) == rows(entries.where("id >= 200")) and rows(late) == rows(entries.where("id < 200"))


def test_splitting_keeps_rows_without_a_time_and_takes_an_empty_stream(spark, scratch):
    folder, path = scratch("in"), scratch("split")
    spark.createDataFrame([(1, None, None, "a"), (1, None, None, "a"), (2, None, "error", None)], SCHEMA).coalesce(1).write.parquet(folder)
    S.split_late(S.open_stream(spark, folder, SCHEMA), "id", path, scratch("checkpoint"), delay="1 day", once=True).awaitTermination()
    assert rows(spark.read.parquet(f"{path}/{S.ON_TIME}").select("id")) == [(1,), (2,)]
    assert spark.read.schema(SCHEMA).parquet(f"{path}/{S.LATE}/batch=*").isEmpty()


def test_a_poll_goes_on_at_the_end_of_the_last_window(spark, log_files, scratch, database):
    _, entries = log_files
    name, path, checkpoint = f"{database}.entries", scratch("polled"), scratch("checkpoint")
    entries.where("id < 300").write.saveAsTable(name)
    start = dt.datetime(2024, 1, 1)

    def poll(seconds, **options):
        end = start + dt.timedelta(seconds=seconds)
        S.poll_table(spark, name, path, checkpoint, time_start=start + dt.timedelta(seconds=100), time_end=end, once=True, **options).awaitTermination()
        return rows(spark.read.schema(SCHEMA).parquet(f"{path}/batch=*"))

    assert poll(200) == rows(entries.where("id between 100 and 199"))
    assert poll(200) == rows(entries.where("id between 100 and 199"))  # nothing new
    entries.where("id >= 300").write.insertInto(name)
    assert poll(400, severity="error") == rows(entries.where("id between 100 and 199 or (id between 200 and 399 and severity = 'error')"))
    with pytest.raises(Exception, match="went back"):
        poll(300)
