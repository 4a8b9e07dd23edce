"""Document fingerprints that tell what differs: invertible Bloom lookup sketches.

A text is a set of digests of its pieces. A sketch adds each digest to three
of its cells, which hold a count, the digests' exclusive or and that of their
checksums. Two versions' sketches are subtracted cell by cell: what they share
is gone, and cells that hold a single digest give it away, so that it can be
taken out of its other cells in turn. Peeling ends with all cells empty and
the differing digests known, or fails, and the two texts are tried again with
sketches of four times the cells.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import bound_batches, col
from millrace.session import materialise

#: Cells of the smallest sketch, which is the fingerprint; a third for each hash.
CELLS = 12
HASHES = 3
#: Bytes of text that a range of documents has, about.
RANGE_BYTES = 64 << 20
#: Words with their blanks.
_words = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*").findall
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def pieces(text: str, every: int = 4) -> list[str]:
    """A text's paragraphs: cut at line ends, at sentence ends and after words that a hash picks, about every ``every``-th.

    Cuts depend on the words themselves, so an edit changes the pieces that it
    touches and no others. White space at their ends doesn't count, and pieces
    without words aren't any.
    """
    found, held = [], []
    for word in _words(text):
        bare = word.rstrip(" \t\n\x0b\x0c\r")
        held.append(bare)
        if bare[-1] in ".!?。！？" or "\n" in word or xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass")) % every == 0:
            found.append(" ".join(held))
            held = []
    if held:
        found.append(" ".join(held))
    return found


def digests(text: str | None) -> np.ndarray:
    """The distinct digests of a text's pieces; the second copy of a piece is another one, and so on."""
    seen: dict[str, int] = {}
    found = []
    for piece in pieces(text or ""):
        nth = seen[piece] = seen.get(piece, -1) + 1
        found.append(xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass"), nth))
    return np.unique(np.array(found, np.uint64))


def _mixed(keys: np.ndarray, n: int) -> np.ndarray:
    """One of four further hashes of digests."""
    x = (keys ^ _FACTORS[n]) * _FACTORS[n - 1]
    x ^= x >> np.uint64(29)
    x *= _FACTORS[n - 2]
    return x ^ (x >> np.uint64(32))


def _checks(keys: np.ndarray) -> np.ndarray:
    return _mixed(keys, 3) & np.uint64(0xFFFFFFFF)


def _places(rows: np.ndarray, keys: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cells of digests, row after row; each hash has a third of a row's cells, so they differ."""
    third = cells // HASHES
    for n in range(HASHES):
        yield rows * cells + n * third + (_mixed(keys, n) % np.uint64(third)).astype(np.int64)


class Sketches:
    """Sketches of equal size for a number of texts: counts, digests and checksums of each cell."""

    def __init__(self, sets: list[np.ndarray], cells: int):
        self.cells, size = cells, len(sets) * cells
        self.count, self.key, self.check = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        if sets:
            self.add(np.repeat(np.arange(len(sets)), list(map(len, sets))), np.concatenate(sets), 1)

    def add(self, rows: np.ndarray, keys: np.ndarray, signs) -> None:
        """Add digests to rows' cells, or take them away where the sign is -1."""
        checks = _checks(keys)
        for at in _places(rows, keys, self.cells):
            np.add.at(self.count, at, signs)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def subtract(self, other: Sketches) -> None:
        self.count -= other.count
        self.key ^= other.key
        self.check ^= other.check

    def texts(self) -> list[str]:
        """Each sketch as text: per cell a count of 4 bytes, a digest of 8 and a checksum of 4, in base 64."""
        cell = np.zeros(len(self.count), np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")]))
        cell["count"], cell["key"], cell["check"] = self.count, self.key, self.check
        width, whole = self.cells * cell.itemsize, cell.tobytes()
        return [base64.b64encode(whole[k:k + width]).decode() for k in range(0, len(whole), width)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, sign) of all that can be taken out, and which rows are empty then.

        After a subtraction a sign of 1 means that only the first text has the
        digest. All rows are peeled together, one layer a round. Rounds are no
        more than cells, as a chance digest could be taken out and put in again.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _ in range(self.cells):
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[self.check[pure] == _checks(self.key[pure])]
            rows, keys = pure // self.cells, self.key[pure]
            # A digest may be alone in several of its cells; a chance digest isn't in a cell of its own.
            home = np.zeros(len(pure), bool)
            for at in _places(rows, keys, self.cells):
                home |= at == pure
            order = np.flatnonzero(home)[np.lexsort((keys[home], rows[home]))]
            rows, keys, signs = rows[order], keys[order], self.count[pure[order]]
            first = np.ones(len(order), bool)
            first[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
            if not first.any():
                break
            rows, keys, signs = rows[first], keys[first], signs[first]
            self.add(rows, keys, -signs)
            found.append((rows, keys, signs))
        held = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return *map(np.concatenate, zip(*found)), ~held.reshape(-1, self.cells).any(axis=1)


def differences(one: list[np.ndarray], two: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets, the digests that only the first has and those that only the second has."""
    found: list = [None] * len(one)
    open_ = np.arange(len(one))
    while len(open_):
        sketch = Sketches([one[k] for k in open_], cells)
        sketch.subtract(Sketches([two[k] for k in open_], cells))
        rows, keys, signs, done = sketch.peel()
        for sign in (1, -1):
            order = np.flatnonzero((signs == sign) & done[rows])
            order = order[np.argsort(rows[order], kind="stable")]
            ends = np.searchsorted(rows[order], np.arange(len(open_) + 1))
            for r in np.flatnonzero(done):
                side = np.sort(keys[order[ends[r]:ends[r + 1]]])
                found[open_[r]] = (side, None) if sign == 1 else (found[open_[r]][0], side)
        open_, cells = open_[~done], cells * 4
    return found


def likeness(one: list[np.ndarray], two: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """The share of digests that both sets of each pair have, of those that either has; 1 for two empty ones."""
    found = differences(one, two, cells)
    less, more = (np.array([len(d[side]) for d in found], np.int64) for side in (0, 1))
    size = np.array(list(map(len, one)), np.int64)
    return np.where(size + more == 0, 1.0, (size - less) / np.maximum(size + more, 1))


def edited(text: str, next_text: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + next_text[:half]


def compare(texts: list[str], next_texts: list[str], cells: int = CELLS) -> dict[str, pa.Array]:
    """Fingerprints of texts and their edited texts, and how like they are to each other and to the next text's."""
    changed = [edited(t, n) for t, n in zip(texts, next_texts)]
    own, new = [digests(t) for t in texts], [digests(t) for t in changed]
    # Most next texts are the next in the list too.
    following = [own[k + 1] if k + 1 < len(texts) and n is texts[k + 1] else digests(n) for k, n in enumerate(next_texts)]
    return {
        "n_chars": pa.array(list(map(len, texts)), pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array(Sketches(own, cells).texts(), pa.string()),
        "edited_fingerprint": pa.array(Sketches(new, cells).texts(), pa.string()),
        "near_edited": pa.array(likeness(own, new, cells), pa.float64()),
        "near_next": pa.array(likeness(own, following, cells), pa.float64()),
    }


_MADE = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_versions(df: DataFrame, text: str = "text", order: str = "doc_id", cells: int = CELLS) -> DataFrame:
    """One row for each row: ``order`` and the fingerprints of its text and of its edited text.

    The edited text has the last half of the code points replaced by as many
    (or all there are) from the next row's text, in the order of ``order``,
    NULLs last; equal ones are ordered by a hash of their texts, and the last
    row is followed by the first. ``near_edited`` and ``near_next`` are the likeness of
    the text's fingerprint to the edited text's and the next text's: digests in
    common of all, 1 where neither has words. NULL is the empty text. Repeated
    rows follow each other, so their order makes no difference. Very long texts
    are taken whole. An empty table gives no rows. No other columns are kept.

    Rows are dealt by ranges of ``order``, so a row and the next are in one
    task; the ends of the ranges are paired in a second, small step. Only the
    numbers of the ranges that hold rows reach the driver. ``order`` is none of
    the names of what is made.
    """
    spark = df.sparkSession
    bound_batches(spark)
    rows = df.select(col(order).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # The row's number deals out rows that are the same; it doesn't matter which of them is where.
    spread = F.monotonically_increasing_id()
    keys = [F.col("key").isNull(), F.col("key"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(tasks, *keys, spread).sortWithinPartitions(*keys)
    made = [f.name for f in T.StructType.fromDDL(_MADE).fields]
    out = T.StructType([T.StructField("key", df.schema[order].dataType), *T.StructType.fromDDL(f"{_MADE}, range__ int, first__ string, last__ string").fields])

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but a range's last, which waits with its text, and the text that a range begins with."""
        number, held, first, kind = TaskContext.get().partitionId(), None, None, None

        def extra(keys, text_first, text_last) -> pa.RecordBatch:
            nulls = [pa.nulls(1, pa.float64() if m.startswith("near") else pa.int64() if m == "n_chars" else pa.string()) for m in made]
            return pa.RecordBatch.from_arrays([keys, *nulls, pa.array([number], pa.int32()), pa.array([text_first], pa.string()), pa.array([text_last], pa.string())], names=out.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = batch["key"], batch["text"].to_pylist()
            kind = keys.type
            if held is None:
                first = texts[0]
            else:
                keys, texts = pa.concat_arrays([held[0], keys]), [held[1], *texts]
            n = len(texts) - 1
            held = keys.slice(n), texts[n]
            if n:
                values = compare(texts[:-1], texts[1:], cells)
                none = pa.nulls(n, pa.string())
                yield pa.RecordBatch.from_arrays([keys.slice(0, n), *[values[m] for m in made], pa.nulls(n, pa.int32()), none, none], names=out.names)
        if held is not None:
            yield extra(pa.nulls(1, kind), first, None)
            yield extra(held[0], None, held[1])

    done = materialise(ranged.mapInArrow(ended, out), "versions", compression="zstd")
    ends = done.filter(F.col("range__").isNotNull())
    numbers = sorted(r[0] for r in ends.filter(F.col("first__").isNotNull()).select("range__").collect())
    following = spark.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1])), "range__ int, next__ int")
    lasts = ends.filter(F.col("last__").isNotNull()).join(following, "range__").select("key", "last__", "next__")
    firsts = ends.filter(F.col("first__").isNotNull()).select(F.col("range__").alias("next__"), "first__")
    rest = T.StructType(out.fields[:-3])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = compare(batch["last__"].to_pylist(), batch["first__"].to_pylist(), cells)
            yield pa.RecordBatch.from_arrays([batch["key"], *[values[m] for m in made]], names=rest.names)

    pairs = lasts.join(firsts, "next__").select("key", "last__", "first__").mapInArrow(paired, rest)
    return done.filter(F.col("range__").isNull()).select(*rest.names).union(pairs).withColumnRenamed("key", order)
