"""Web archives without repeated payloads.

Headers are grouped by payload digest. One record of each digest is the original
response; the others become revisit records that name it and carry no payload.
Archives are written by Spark as text, a record after the other with fresh
headers, and are read back whole, record by record, by the length in the header.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import col, unused
from millrace.session import materialise

#: Payloads under this many bytes are always written out.
LEAST_BYTES = 1000
#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
RECORD = "record_id string, refers_to string, record_type string, uri string, payload_digest string, payload_bytes long, content string"
_NAMES = {"WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Type": "record_type", "WARC-Target-URI": "uri", "WARC-Payload-Digest": "payload_digest", "X-Payload-Length": "payload_bytes"}


def resolve(pages: DataFrame, order: str = "page_id", payload: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """The rows with ``payload_digest``, ``payload_bytes``, ``record_type``, ``refers_to`` and ``copy``.

    Of the records with one payload of at least ``least`` bytes, that with the
    largest ``order`` is the response and the others are revisits that refer to
    it. A NULL payload is empty. Rows that repeat the largest ``order`` are one
    response, numbered 0 by ``copy``, and revisits of it from 1 on; a NULL order
    is smaller than all. Columns called like a result are replaced.
    """
    own = ["payload_digest", "payload_bytes", "record_type", "refers_to", "copy"]
    kept = [col(c) for c in pages.columns if c not in own]
    body = F.coalesce(col(payload), F.lit("")).cast("binary")
    rows = pages.select(*kept, F.sha1(body).alias("payload_digest"), F.octet_length(body).cast("long").alias("payload_bytes"))
    headers = rows.filter(F.col("payload_bytes") >= least)
    same = headers.groupBy("payload_digest", col(order).alias("o")).agg(F.count(F.lit(1)).alias("n"))
    originals = same.groupBy(F.col("payload_digest").alias("d")).agg(F.max(F.struct("o", "n")).alias("top"), F.sum("n").alias("records"))
    # Only digests that come more than once need anything resolved.
    originals = materialise(originals.filter("records > 1").select("d", F.col("top.o").alias("o"), F.col("top.n").alias("ties")), "originals")
    joined = rows.join(originals, F.col("payload_digest") == F.col("d"), "left")
    is_top = F.col("d").isNull() | col(order).eqNullSafe(F.col("o"))
    joined = joined.withColumn("top__", is_top)
    if originals.filter("ties > 1").isEmpty():
        joined = joined.withColumn("copy", F.lit(0).cast("long"))
    else:
        tied = F.col("top__") & (F.coalesce("ties", F.lit(1)) > 1)
        number = F.row_number().over(Window.partitionBy("payload_digest", col(order)).orderBy(*[F.xxhash64(c) for c in kept]))
        first = joined.filter(tied).withColumn("copy", number.cast("long") - 1)
        joined = first.unionByName(joined.filter(~tied).withColumn("copy", F.lit(0).cast("long")))
    response = F.col("top__") & (F.col("copy") == 0)
    return joined.select(
        *kept, "payload_digest", "payload_bytes", F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("o")).alias("refers_to"), "copy",
    )


def record_id(order: Column, copy: Column | None = None) -> Column:
    """The URN of a page's record."""
    copy = F.lit(0) if copy is None else copy
    return F.concat(F.lit("<urn:page:"), F.coalesce(order.cast("string"), F.lit("null")), F.when(copy > 0, F.concat(F.lit(":"), copy.cast("string"))).otherwise(""), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; empty for NULL. Line ends in a value become blanks."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.translate(value, "\r\n", "  "), F.lit("\r\n")), F.lit(""))


def write_archives(records: DataFrame, path: str, order: str = "page_id", payload: str = "html", uri: str = "url", compression: str = "gzip") -> None:
    """Write resolved records as archives, a file for each partition, with headers of their own."""
    body = F.when(F.col("record_type") == "response", F.coalesce(col(payload), F.lit(""))).otherwise("")
    lines = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", record_id(col(order), F.col("copy"))),
        _header("WARC-Date", F.lit(_DATE)),
        _header("WARC-Target-URI", col(uri)),
        _header("WARC-Refers-To", F.when(F.col("record_type") == "revisit", record_id(F.col("refers_to")))),
        _header("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body, F.lit("\r\n\r"),  # the writer ends a row with the last \n
    )
    records.select(lines.alias("value")).write.option("compression", compression).text(path)


def parse(data: bytes) -> Iterator[dict]:
    """The records of an archive, by the lengths that their headers give."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record starts at byte {at}")
        header = dict(line.split(": ", 1) for line in lines)
        begin = end + 4
        size = int(header["Content-Length"])
        record = {column: header.get(name) for name, column in _NAMES.items()}
        record["payload_bytes"] = int(record["payload_bytes"])
        record["payload_digest"] = record["payload_digest"].removeprefix("sha1:")
        record["content"] = data[begin:begin + size].decode()
        yield record
        at = begin + size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder: ``RECORD``."""
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"payload_bytes": pa.int64()}
        for batch in batches:
            for k in range(batch.num_rows):
                data, rows, size = batch[0][k].as_py(), [], 0
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                for record in parse(data):
                    rows.append(record)
                    size += len(record["content"])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in columns], names=columns)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in columns], names=columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(records, RECORD)


def with_payloads(records: DataFrame) -> DataFrame:
    """Records as read, revisits with the payload of the response that they refer to."""
    source = records.filter("record_type = 'response'").select(F.col("record_id").alias("o"), F.col("content").alias("payload"))
    key, own = unused(records, "key__", "own__")
    joined = records.withColumn(key, F.coalesce("refers_to", "record_id")).withColumnRenamed("content", own)
    return joined.join(source, F.col(key) == F.col("o"), "left").select(*[own if c == "content" else c for c in records.columns if c != "content"], F.coalesce("payload", own).alias("content"))
