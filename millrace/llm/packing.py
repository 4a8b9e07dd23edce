"""Packing token sequences with minimum bin slack.

Documents are cut at the window, so what has to be packed are lengths up to
the window: a multiset with one count a length, however many documents there
are. Each pattern fills a window: the longest remaining length is taken, and a
subset sum over the counts, as bitsets, finds what fills the rest best. A
pattern is repeated while the counts last. Pieces are numbered within their
length and find their place in the patterns by that number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bpe import encoder
from millrace.llm.common import bound_batches, col, unused
from millrace.session import materialise

WINDOW = 2048
#: Fewer empty ids than this at the end of a window are padding; for more, an item is cut.
LEAST_CUT = 16
_PIECE = "start long, length long, ids binary, doc_tokens long, part int, nth long"
_OUT_BYTES = 4 << 20


def fill(counts: dict[int, int], window: int) -> dict[int, int]:
    """How often to take each length so that the sum comes closest to ``window`` from below."""
    reach, goal = 1, 1 << window
    mask = (goal << 1) - 1
    steps: list[tuple[int, int, int]] = []  # (length, copies, bits before)
    for length in sorted((n for n in counts if n <= window and counts[n]), reverse=True):
        left, copies = min(counts[length], window // length), 1
        while left and not reach & goal:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= reach << (length * copies) & mask
            left -= copies
            copies *= 2
        if reach & goal:
            break
    at, taken = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not before >> at & 1:
            at -= length * copies
            taken[length] = taken.get(length, 0) + copies
    return taken


def plan_windows(counts: dict[int, int], window: int = WINDOW, least_cut: int = LEAST_CUT) -> list[tuple]:
    """Where each numbered item of each length goes.

    Rows (length, from_item, to_item, skip, take, nth, each, sequence, offset):
    of these items, the ``take`` ids after ``skip``. The first such item is the
    ``nth`` of a run of which each sequence from ``sequence`` on gets ``each``,
    at ``offset`` and behind each other. Where ``least_cut`` or more ids of a
    window would stay empty, the longest item left is cut to fill it, and its
    rest is a length of its own from then on.
    """
    #: By length: runs (original length, from_item, to_item, skip) of what is left.
    left = {n: [(n, 0, c, 0)] for n, c in counts.items() if c}
    counts, rows, sequence = {n: c for n, c in counts.items() if c}, [], 0

    def take(length: int, size: int, times: int, each: int, offset: int) -> list[tuple]:
        """Places the first ``size`` ids of the next times * each items; returns the runs they are from."""
        wanted, nth, taken, runs = times * each, 0, [], left[length]
        while nth < wanted:
            original, begin, end, skip = runs.pop()
            stop = min(end, begin + wanted - nth)
            if stop < end:
                runs.append((original, stop, end, skip))
            rows.append((original, begin, stop, skip, size, nth, each, sequence, offset))
            taken.append((original, begin, stop, skip))
            nth += stop - begin
        counts[length] -= wanted
        if not counts[length]:
            del counts[length], left[length]
        return taken

    while counts:
        longest = max(counts)
        counts[longest] -= 1
        taken = fill(counts, window - longest)
        counts[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in taken.items())
        slack = window - sum(n * k for n, k in taken.items())
        rest = [n for n in counts if counts[n] > taken.get(n, 0) * times] if slack >= least_cut else []
        if rest:
            extra = max(rest)
            times = min(times, counts[extra] // (taken.get(extra, 0) + 1) or 1)
        at = 0
        for n in sorted(taken, reverse=True):
            take(n, n, times, taken[n], at)
            at += n * taken[n]
        if rest:
            size = extra - slack
            for original, begin, end, skip in take(extra, slack, times, 1, at):
                left.setdefault(size, []).append((original, begin, end, skip + slack))
                counts[size] = counts.get(size, 0) + end - begin
        sequence += times
    return rows


def cut(df: DataFrame, path: str, text: str = "text", columns: list[str] | None = None, window: int = WINDOW, end_id: int = 1, forget: bool = False) -> DataFrame:
    """Each document's ids and the end id, in pieces of ``window`` and a rest; written once.

    Columns: those named, ``start``, ``length``, ``ids`` (unsigned 32-bit
    numbers, lowest byte first), ``doc_tokens``, and ``part`` and ``nth``, which
    number the pieces of a length within a written part. A NULL or empty text
    is the end id alone. Columns of these names in ``df`` are replaced. With
    ``forget`` a worker keeps nothing of a part's texts once it is done, which
    leaves the memory to other stages and has words encoded once a part.
    """
    made = [c.split()[0] for c in _PIECE.split(", ")]
    keep = [c for c in (df.columns if columns is None else columns) if c not in made]
    bound_batches(df.sparkSession)
    carried = df.select(*[col(c) for c in keep])
    schema = T.StructType(carried.schema.fields + T.StructType.fromDDL(_PIECE).fields)
    body = unused(carried, "text__")[0]
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, part, seen = encoder(path, trie=False), TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for whole in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(whole[body]), 0).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < whole.num_rows:
                limit = (sizes[begin - 1] if begin else 0) + _OUT_BYTES
                batch = whole.slice(begin, max(1, int(np.searchsorted(sizes, limit)) - begin))
                begin += batch.num_rows
                each = [b + end for b in engine.encode(batch[body].to_pylist())]
                tokens = np.array([len(b) // 4 for b in each], np.int64)
                n = -(-tokens // window)
                row = np.repeat(np.arange(len(each)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * window
                length = np.minimum(tokens[row] - start, window)
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.searchsorted(sorted_, sorted_) + seen[sorted_]
                seen += np.bincount(length, minlength=window + 1)
                ids = [each[r][4 * s: 4 * (s + k)] for r, s, k in zip(row, start, length)]
                taken = [batch[c].take(pa.array(row)) for c in keep]
                own = [pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(tokens[row]), pa.array(np.full(len(row), part, np.int32)), pa.array(nth)]
                yield pa.RecordBatch.from_arrays(taken + own, names=[f.name for f in schema])
        if forget:
            engine.forget()
            pa.default_memory_pool().release_unused()

    return materialise(df.select(*[col(c) for c in keep], col(text).alias(body)).mapInArrow(pieces, schema), "pieces", compression="zstd")


def place(pieces: DataFrame, window: int = WINDOW, least_cut: int = LEAST_CUT) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, in place of ``part`` and ``nth``.

    Only one count for each length reaches the driver. Each id is in one piece,
    each piece in one sequence, and offsets of a sequence leave no gap. An
    empty table gives no rows.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = materialise(counts, "lengths")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_windows(lengths, window, least_cut),
        "length long, from_item long, to_item long, skip long, take long, run_nth long, each long, first_sequence long, first_offset long",
    )
    # Which items of a part's length lie in which run; the plan has rows for the lengths, not for the pieces.
    spans = counts.join(F.broadcast(plan), "length").filter((F.col("base") < F.col("to_item")) & (F.col("from_item") < F.col("base") + F.col("n"))).drop("n")
    item = F.col("base") + F.col("nth")
    placed = pieces.join(spans, ["part", "length"]).filter((item >= F.col("from_item")) & (item < F.col("to_item")))
    nth = item - F.col("from_item") + F.col("run_nth")
    changed = {
        "start": F.col("start") + F.col("skip"), "length": F.col("take"),
        "ids": F.col("ids").substr(F.col("skip").cast("int") * 4 + 1, F.col("take").cast("int") * 4),
    }
    kept = [c for c in pieces.columns if c not in ("part", "nth", "sequence_id", "offset")]
    return placed.select(
        *[changed[c].alias(c) if c in changed else col(c) for c in kept],
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("take")).alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths): the packed ids of each sequence, and where its pieces end."""
    gathered = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return gathered.select("sequence_id", joined.alias("ids"), F.transform("pieces", lambda p: p["length"]).alias("lengths"))
