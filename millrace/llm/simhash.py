"""Near-duplicates by SimHash fingerprints and a self-join of binary tries.

Two fingerprints within ``budget`` bits agree in one of ``budget + 1`` bands,
so each band's value names a bucket that one task can join alone. There the
sorted fingerprints are a binary trie: a node is a range with a common prefix.
Pairs of nodes go down together, a level at a time, adding up the bits in which
they differ; a pair over the budget is dropped with all that lies below it.
Large buckets are dealt into chunks, and every pair of chunks is a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, col, tasks_for, unused
from millrace.session import materialise

BITS = 64
#: Fingerprints of a bucket that are joined in one task; more are dealt into chunks.
BUCKET_ROWS = 20_000
#: Node pairs that are looked at together.
FRONTIER = 1_000_000
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned SimHash of a text; zero if it has no words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not tokens:
        return 0
    joined, ends, at = b" ".join(tokens), [], -1
    for token in tokens:
        at += len(token) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[min(words, len(tokens)) - 1:]
    digest, total = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for k in range(0, len(last), _SHINGLES_AT_ONCE):
        part = last[k:k + _SHINGLES_AT_ONCE]
        hashes = b"".join([digest(joined[s:e], seed) for s, e in zip(starts[k:k + len(part)], part)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(last)).tobytes(), "big")


def fingerprints(text: Column, words: int = 3, seed: int = 42) -> Column:
    """The SimHash of a text column, as the signed long of the same 64 bits."""

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, words, seed) for t in texts.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return hashed(text)


def majority(hashes: np.ndarray) -> int:
    """The unsigned SimHash of hashes that are there already; zero of none."""
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[k:k + _SHINGLES_AT_ONCE].astype(">u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray, edges: list | None = None) -> np.ndarray:
    """Labels after joining the components of i and j; a label is the smallest index. Pairs that joined any go to ``edges``."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        if not len(i):
            break
        high, low = np.maximum(a, b), np.minimum(a, b)
        np.minimum.at(label, high, low)
        if edges is not None:
            taken = np.flatnonzero(label[high] == low)
            taken = taken[np.unique(high[taken], return_index=True)[1]]
            edges.append((i[taken], j[taken]))
        while not np.array_equal(label[label], label):
            label = label[label]
    return label


def trie_join(x: np.ndarray, roots: np.ndarray, depth: int, budget: int, label: np.ndarray | None = None, edges: list | None = None) -> np.ndarray:
    """Component labels over ``x`` after joining the tries that ``roots`` pairs.

    ``x`` holds distinct unsigned values, sorted within each root's range;
    ``roots`` has rows (a_lo, a_hi, b_lo, b_hi) of ranges whose values share
    their first ``depth`` bits. Equal ranges are joined with themselves.
    Links within a component that is known already are not followed; ``label``
    has those known before. The pairs (i, j) that joined components go to
    ``edges``: both ends are within the budget.
    """
    label = np.arange(len(x)) if label is None else label
    bits = [np.concatenate([[0], np.cumsum((x >> np.uint64(BITS - 1 - d)) & np.uint64(1), dtype=np.int64)]) for d in range(BITS)]
    todo = [(depth, roots, np.zeros(len(roots), np.int8))]
    while todo:
        depth, pairs, differ = todo.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            todo += [(depth, pairs[half:], differ[half:]), (depth, pairs[:half], differ[:half])]
            continue
        known = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        a_lo, a_hi, b_lo, b_hi = pairs.T
        same = a_lo == b_lo
        joined = (known[a_lo] == known[a_hi - 1]) & (known[b_lo] == known[b_hi - 1]) & (label[a_lo] == label[b_lo])
        pairs, differ, same = pairs[~joined], differ[~joined], same[~joined]
        sizes = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        small = (sizes <= 16) | (depth == BITS)
        if small.any():
            p, n = pairs[small], sizes[small]
            which = np.repeat(np.arange(len(p)), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            width = (p[:, 3] - p[:, 2])[which]
            i, j = p[which, 0] + k // width, p[which, 2] + k % width
            near = (np.bitwise_count(x[i] ^ x[j]) <= budget) & (i != j)
            label = _merge(label, i[near], j[near], edges)
        pairs, differ, same = pairs[~small], differ[~small], same[~small]
        if not len(pairs):
            continue
        ones = bits[depth]
        a_lo, a_hi, b_lo, b_hi = pairs.T
        a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
        zero = np.column_stack([a_lo, a_mid, b_lo, b_mid])
        one = np.column_stack([a_mid, a_hi, b_mid, b_hi])
        cross = np.column_stack([a_lo, a_mid, b_mid, b_hi])
        back = np.column_stack([a_mid, a_hi, b_lo, b_mid])[~same]
        pairs = np.concatenate([cross, back, zero, one])
        differ = np.concatenate([differ + 1, differ[~same] + 1, differ, differ])
        fits = (differ <= budget) & (pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])
        fits &= ~((pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] - pairs[:, 0] == 1))
        todo.append((depth + 1, pairs[fits], differ[fits]))
    return label


def _bounds(key: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows, and the end."""
    if not len(key):
        return np.zeros(1, np.int64)
    change = (key[1:] != key[:-1]).any(axis=1)
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(key)]])


def _join_buckets(budget: int, band_bits: int):
    """For one partition of whole buckets: links that span its components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        column = {n: table[n].to_numpy() for n in table.column_names}
        x = column["rotated"].astype(np.int64).view(np.uint64)
        bucket = x >> np.uint64(BITS - band_bits)
        order = np.lexsort((x, column["chunk"], column["hi"], column["lo"], bucket, column["band"]))
        x, band = x[order], column["band"][order]
        key = np.column_stack([band, bucket[order].astype(np.int64), column["lo"][order], column["hi"][order]])
        chunk = column["chunk"][order]
        edges, roots = _bounds(key), []
        lo, hi = key[edges[:-1], 2], key[edges[:-1], 3]
        for s, e, a, b in zip(edges[:-1], edges[1:], lo, hi):
            if a == b:
                if e - s > 1:
                    roots.append((s, e, s, e))
            else:
                mid = s + int(np.searchsorted(chunk[s:e], b))
                if s < mid < e:
                    roots.append((s, mid, mid, e))
        if not roots:
            return
        label = trie_join(x, np.array(roots, np.int64), band_bits, budget)
        linked = np.flatnonzero(label != np.arange(len(x)))
        turn = (band * band_bits).astype(np.uint64)
        plain = np.where(turn == 0, x, (x >> turn) | (x << ((np.uint64(BITS) - turn) % np.uint64(BITS))))
        yield pa.RecordBatch.from_arrays([pa.array(plain[linked].view(np.int64)), pa.array(plain[label[linked]].view(np.int64))], names=["a", "b"])

    return run


def links(prints: DataFrame, rows: int, budget: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``budget`` bits.

    ``prints`` has one long column of distinct values, ``rows`` of them. The
    result spans the components of each bucket; it isn't all pairs.
    """
    spark, bands = prints.sparkSession, budget + 1
    band_bits = BITS // bands
    value = col(prints.columns[0])
    turned = [
        F.struct(F.lit(b).alias("band"), (F.shiftleft(value, b * band_bits).bitwiseOR(F.shiftrightunsigned(value, BITS - b * band_bits)) if b else value).alias("rotated"))
        for b in range(bands)
    ]
    banded = prints.select(F.inline(F.array(*turned)))
    banded = banded.withColumn("bucket", F.shiftrightunsigned("rotated", BITS - band_bits))
    large = banded.groupBy("band", "bucket").count().filter(F.col("count") > bucket_rows)
    large = large.select("band", "bucket", F.ceil(F.col("count") / F.lit(bucket_rows)).cast("int").alias("chunks"))
    chunked = banded.join(large, ["band", "bucket"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("rotated"), F.col("chunks")).cast("int"))
    dealt = chunked.select("band", "bucket", "rotated", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("band", "bucket", "rotated", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    dealt = dealt.repartition(tasks_for(bands * rows, spark), "band", "bucket", "lo", "hi").drop("bucket")
    return dealt.mapInArrow(_join_buckets(budget, band_bits), "a long, b long").distinct()


def _join_members(budgets: tuple[int, ...]):
    """For one partition of whole groups (key, chunk): pairs that span the groups' components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        key, chunk, node = (table[n].to_numpy().astype(np.int64) for n in ("key", "chunk", "node"))
        x = table["fingerprint"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.lexsort((node, x, chunk, key))
        group, x, node = np.column_stack([key, chunk])[order], x[order], node[order]
        # Of equal fingerprints the first goes into the trie, and the others are paired with it.
        first = _bounds(np.column_stack([group, x.view(np.int64)]))
        lead = node[np.repeat(first[:-1], np.diff(first))]
        x, head = x[first[:-1]], node[first[:-1]]
        ends = _bounds(group[first[:-1]])
        roots = np.column_stack([ends[:-1], ends[1:], ends[:-1], ends[1:]])[np.diff(ends) > 1]
        label, edges = None, []
        for budget in budgets:  # the nearest first, so pairs that join components are near ones where there are any
            label = trie_join(x, roots, 0, budget, label, edges)
        other = node != lead
        a = np.concatenate([node[other], *(head[i] for i, _ in edges)])
        b = np.concatenate([lead[other], *(head[j] for _, j in edges)])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def group_pairs(members: DataFrame, rows: int, budgets: tuple[int, ...]) -> DataFrame:
    """Pairs of nodes (a, b) that span, in each group, what links of fingerprints within the last of ``budgets`` bits reach.

    ``members`` has ``key`` and ``chunk``, which name the group, ``node`` and
    ``fingerprint`` (longs), ``rows`` of them; a group has to fit a task. Each
    pair is within a budget, and within a smaller one if that joins its ends.
    """
    dealt = members.select("key", "chunk", "node", "fingerprint").repartition(tasks_for(rows, members.sparkSession), "key", "chunk")
    return dealt.mapInArrow(_join_members(tuple(budgets)), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the component's smallest.

    Large-star and small-star steps in turn, each round written to the shared
    folder, until the links no longer change.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs, seen = materialise(pairs, "links"), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        wide = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        near = wide.join(least, F.col("a") == F.col("u")).select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))))
        pairs = materialise(near.filter("a <> b").distinct(), "links")


def near_groups(df: DataFrame, text: str = "text", member: Column | None = None, words: int = 3, budget: int = 3,
                bucket_rows: int = BUCKET_ROWS, columns: list[str] | None = None) -> DataFrame:
    """The rows with ``fingerprint`` (long) and ``first``, the least ``member`` of the row's group.

    Rows link when their fingerprints differ in ``budget`` bits at most, and a
    group is all that links reach. ``member`` is any ordered expression over
    the columns (by default the first column); NULLs don't count as least, and
    a group with NULLs only has ``first`` NULL. A NULL text has no words and the
    fingerprint zero, which links like any other. Repeated rows stay. Columns
    that are called ``fingerprint`` or ``first`` already are replaced.
    ``columns`` names those to keep (all). An empty table gives no rows.
    """
    bound_batches(df.sparkSession)
    keep = [c for c in (columns or df.columns) if c not in ("fingerprint", "first")]
    print_, least = unused(df, "print__", "least__")
    rows = df.select(*[col(c) for c in keep], (col(df.columns[0]) if member is None else member).alias(least), fingerprints(col(text), words).alias(print_))
    rows = materialise(rows, "fingerprints")
    groups = materialise(rows.groupBy(print_).agg(F.min(least).alias("least")), "groups")
    found = links(groups.select(print_), groups.count(), budget, bucket_rows)
    roots = connected(found)
    named = groups.join(roots, F.col(print_) == F.col("node"), "left").select(print_, "least", F.coalesce("root", print_).alias("root"))
    firsts = named.groupBy("root").agg(F.min("least").alias("first"))
    linked = roots.select("root").distinct()
    # Only fingerprints that have links need their component's least; the others are their own.
    firsts = firsts.join(linked, "root", "left_semi")
    ends = named.join(firsts, "root", "left").select(F.col(print_).alias("fingerprint"), F.coalesce("first", "least").alias("first"))
    return rows.join(ends, F.col(print_) == F.col("fingerprint")).select(*[col(c) for c in keep], "fingerprint", "first")


def keep_first(df: DataFrame, text: str = "text", order: str = "doc_id", words: int = 3, budget: int = 3) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``df``.

    The row with the smallest ``order`` stays (NULLs last); of rows that tie,
    one. Nothing else is dropped.
    """
    bound_batches(df.sparkSession)
    row, member, print_ = unused(df, "row__", "member__", "print__")
    # Rows get an id when they are written, so one of several equal rows can be told.
    fixed = materialise(df.select("*", fingerprints(col(text), words).alias(print_), F.monotonically_increasing_id().alias(row)), "documents")
    member_of = F.struct(col(order).isNull(), col(order), col(row))
    groups = materialise(fixed.groupBy(print_).agg(F.min(member_of).alias(member)), "groups")
    roots = connected(links(groups.select(print_), groups.count(), budget))
    named = groups.join(roots, F.col(print_) == F.col("node"), "left").select(member, F.coalesce("root", print_).alias("root"))
    stay = named.groupBy("root").agg(F.min(member).alias(member)).select(F.col(member)[row].alias("stays"))
    return fixed.join(stay, F.col(row) == F.col("stays"), "left_semi").select(*[col(c) for c in df.columns])
