"""Session helpers: the shared folder and written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: What a task that writes sorted rows reads of a shuffle, in compressed bytes; ten and more times that in memory.
SHARE_BYTES = 16 << 20


def build_session(app_name: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session for scripts and tests; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset it is the warehouse folder, which a cluster shares too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/millrace/{uuid.uuid4().hex}/{label}"


@contextmanager
def bounded_shares(spark: SparkSession, sorted_: bool = True) -> Iterator[None]:
    """Writes within it have AQE deal shuffled rows in shares of ``SHARE_BYTES``; a lower setting of the session stays.

    Writers into partitions sort their rows, so a task's memory goes with its
    share. Where nothing is ``sorted_`` all stays as it is.
    """
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    held = spark.conf.get(name)
    if not sorted_ or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) <= SHARE_BYTES:
        yield
        return
    spark.conf.set(name, str(SHARE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, held)


def materialise(df: DataFrame, label: str = "rows", **options) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    This cuts the lineage at a table that outlives any executor, so values
    such as row ids are fixed from here on. ``options`` are the writer's.
    ``discard`` removes what was written.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``materialise`` returned, once its results are used."""
    files = df.inputFiles()
    spark = df.sparkSession
    if not files:
        return
    folder = files[0].rsplit("/", 1)[0]
    if "/millrace/" not in folder:
        raise ValueError(f"{folder} isn't a folder of intermediates")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
