"""Small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow shuffled table that one task takes.
TASK_ROWS = 250_000


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def col(name: str):
    """A column by its plain name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def tasks_for(rows: int, spark, rows_per_task: int = TASK_ROWS) -> int:
    """A number of tasks that grows with the rows and is no less than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


#: Bytes of texts that a Python worker gets at once, or of one text if that is longer.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches, which else hold 10,000 rows however long their texts are.

    The session keeps the lower bound, as plans run after the operator returns.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not (held.rstrip("bB").isdigit() and 0 < int(held.rstrip("bB")) <= BATCH_BYTES):
        spark.conf.set(name, str(BATCH_BYTES))
