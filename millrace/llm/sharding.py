"""Resharding with the fewest bytes moved.

Shards are folders of files, one for each block, a stretch of rows in a fixed
order. From the old shards' sizes and the new capacities a minimum-cost flow
says how many bytes go from where to where; staying costs nothing, moving one
for each byte. Blocks follow the flow whole. The few that a boundary falls into
are split at a row. Only files of blocks that move, or are split, are written
anew; all others stay where they are.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import col, unused
from millrace.session import materialise, scratch_path

_RANK_BITS = (1 << 33) - 1


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for NULL, and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def min_cost_flow(edges: Sequence[tuple[int, int, int, int]], nodes: int, source: int, sink: int) -> list[int]:
    """The flow on each edge (from, to, capacity, cost) of a cheapest maximum flow.

    Shortest augmenting paths with potentials; costs are not negative.
    """
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, room, price = [], [], []
    for a, b, capacity, cost in edges:
        for x, y, r, c in ((a, b, capacity, cost), (b, a, 0, -cost)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            price.append(c)
    potential = [0] * nodes
    while True:
        far, via = [None] * nodes, [-1] * nodes
        far[source], heap = 0, [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for e in graph[x]:
                y, new = to[e], d + price[e] + potential[x] - potential[to[e]]
                if room[e] and (far[y] is None or new < far[y]):
                    far[y], via[y] = new, e
                    heapq.heappush(heap, (new, y))
        if far[sink] is None:
            return [room[2 * k + 1] for k in range(len(edges))]
        potential = [p + (f if f is not None else far[sink]) for p, f in zip(potential, far)]
        push, y = None, sink
        while y != source:
            push = room[via[y]] if push is None else min(push, room[via[y]])
            y = to[via[y] ^ 1]
        y = sink
        while y != source:
            room[via[y]] -= push
            room[via[y] ^ 1] += push
            y = to[via[y] ^ 1]


def transfers(old: Sequence[int], new: Sequence[int]) -> list[tuple[int, int, int]]:
    """(from shard, to shard, bytes) that turn the old sizes into the new ones, what stays included.

    Shard k is the same before and after. All that moves passes one hub, so
    there are as many edges as shards. ``new`` adds up to ``old``.
    """
    n, hub, source = max(len(old), len(new)), 2 * max(len(old), len(new)), 2 * max(len(old), len(new)) + 1
    edges = [(source, i, size, 0) for i, size in enumerate(old)]
    edges += [(n + j, source + 1, size, 0) for j, size in enumerate(new)]
    stay = len(edges)
    edges += [(i, n + i, min(old[i], new[i]), 0) for i in range(min(len(old), len(new)))]
    out = len(edges)
    edges += [(i, hub, size, 1) for i, size in enumerate(old)]
    into = len(edges)
    edges += [(hub, n + j, size, 0) for j, size in enumerate(new)]
    flow = min_cost_flow(edges, source + 2, source, source + 1)
    found = [(i, i, flow[stay + i]) for i in range(out - stay)]
    gives = [[i, flow[out + i]] for i in range(len(old)) if flow[out + i]]
    takes = [[j, flow[into + j]] for j in range(len(new)) if flow[into + j]]
    while gives and takes:
        moved = min(gives[0][1], takes[0][1])
        found.append((gives[0][0], takes[0][0], moved))
        for side in (gives, takes):
            side[0][1] -= moved
            if not side[0][1]:
                side.pop(0)
    return [t for t in found if t[2]]


def equal_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


@dataclass(frozen=True)
class Layout:
    """Rows in shards: the files, and where each stretch of a block belongs.

    ``rows`` reads the files, with ``block``, ``row_in_block`` and ``row_size``;
    ``stretches`` has (block, from_row, to_row, shard, first_slot, bytes).
    """

    rows: DataFrame
    stretches: DataFrame
    shards: int
    hidden: tuple[str, str, str]

    def read(self, columns: Sequence[str] | None = None, *derived: Column) -> DataFrame:
        """The rows with ``shard`` and ``slot``, their place there from 0; ``derived`` is worked out while the files are read."""
        block, rank, _ = self.hidden
        own = [c for c in self.rows.columns if c not in self.hidden and c not in ("shard", "slot")]
        kept = self.rows.select(block, rank, *[col(c) for c in (own if columns is None else columns)], *derived)
        s = self.stretches.select(F.col("block").alias("s_block__"), "from_row", "to_row", F.col("shard").alias("s_shard__"), "first_slot")
        placed = kept.join(s, (col(block) == F.col("s_block__")) & (col(rank) >= F.col("from_row")) & (col(rank) < F.col("to_row")))
        return placed.select(*[c for c in kept.columns if c not in (block, rank)], F.col("s_shard__").cast("int").alias("shard"), (F.col("first_slot") + col(rank) - F.col("from_row")).alias("slot"))


def _slots(stretches: DataFrame) -> DataFrame:
    before = Window.partitionBy("shard").orderBy("block", "from_row").rowsBetween(Window.unboundedPreceding, -1)
    return stretches.withColumn("first_slot", F.coalesce(F.sum(F.col("to_row") - F.col("from_row")).over(before), F.lit(0)))


def write_shards(df: DataFrame, shard: Column, size: Column, shards: int, keys: Sequence[Column]) -> Layout:
    """Write rows into the shard folders that ``shard`` names, large rows first, then by ``keys``.

    Sizes fall by powers of two and rows are spread by the hash of the keys
    within, so boundaries meet small rows and no key's rows need one task.
    """
    block, rank, weight = hidden = unused(df, "block__", "row_in_block__", "row_size__")
    at, class_, spread = unused(df, "at__", "class__", "spread__")
    rows = df.withColumns({at: shard, weight: size, spread: F.xxhash64(*keys)})
    rows = rows.withColumn(class_, -F.floor(F.log2(col(weight).cast("double"))))
    rows = rows.repartitionByRange(at, class_, spread).sortWithinPartitions(at, class_, spread, *keys)
    number = F.monotonically_increasing_id()
    rows = rows.drop(class_, spread).withColumn(rank, number)
    # A task's rows of one shard are a block: the task and the shard name it.
    rows = rows.withColumns({block: F.shiftright(rank, 33) * shards + col(at), rank: col(rank).bitwiseAND(F.lit(_RANK_BITS))})
    path = scratch_path(df.sparkSession, "shards")
    rows = rows.withColumnRenamed(at, "in_shard__")
    rows.write.partitionBy("in_shard__").option("compression", "zstd").parquet(path)
    whole = df.sparkSession.read.schema(rows.schema).parquet(path)
    written = whole.drop("in_shard__")
    stretches = whole.groupBy(col(block).alias("block")).agg(
        F.min(rank).alias("from_row"), (F.max(rank) + 1).alias("to_row"), F.first("in_shard__").cast("int").alias("shard"), F.sum(weight).alias("bytes"))
    return Layout(written, materialise(_slots(stretches), "stretches"), shards, tuple(hidden))


def reshard(layout: Layout, capacities: Sequence[int] | None = None, shards: int | None = None) -> Layout:
    """The layout with sizes as near to the capacities as rows allow, moving the fewest bytes.

    Without ``capacities``, ``shards`` equal ones. Each boundary is off by half
    of the row that it meets at most; no row is split. Files of untouched
    blocks are kept, the others are rewritten by new shard. An empty layout
    stays empty. Equal rows may be parted.
    """
    spark = layout.rows.sparkSession
    block, rank, weight = layout.hidden
    sizes = {r["shard"]: r["b"] for r in layout.stretches.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    old = [sizes.get(i, 0) for i in range(layout.shards)]
    new = list(capacities) if capacities is not None else equal_sizes(sum(old), shards)
    if sum(new) != sum(old):
        raise ValueError(f"the capacities hold {sum(new)} bytes, the shards {sum(old)}")
    segments, ends = [], {}
    for i, j, n in sorted(transfers(old, new), key=lambda t: (t[0], t[0] != t[1], t[1])):
        segments.append((i, j, ends.get(i, 0), ends.get(i, 0) + n))
        ends[i] = segments[-1][3]
    segments = spark.createDataFrame(segments, "old int, target int, from_byte long, to_byte long")
    before = Window.partitionBy("shard").orderBy("block", "from_row").rowsBetween(Window.unboundedPreceding, -1)
    stretches = layout.stretches.withColumn("begin", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    # A shard has fewer segments than there are shards, so this has rows for blocks and boundaries.
    crossed = stretches.join(segments, (F.col("shard") == F.col("old")) & (F.col("from_byte") < F.col("begin") + F.col("bytes")) & (F.col("to_byte") > F.col("begin")))
    whole = (F.col("from_byte") <= F.col("begin")) & (F.col("to_byte") >= F.col("begin") + F.col("bytes"))
    crossed = materialise(crossed.withColumn("whole", whole), "crossed")
    kept = crossed.filter("whole").select("block", "from_row", "to_row", F.col("shard").alias("old"), F.col("target").alias("shard"), "bytes")
    # Of split blocks, the rows: a block is a task's rows, and there are fewer split blocks than segments.
    split = crossed.filter("not whole").select("block", "from_row", "to_row", "begin", "shard").distinct()
    rows = layout.rows.select(col(block).alias("b"), col(rank).alias("r"), col(weight).alias("w"))
    rows = rows.join(split, (F.col("b") == F.col("block")) & (F.col("r") >= F.col("from_row")) & (F.col("r") < F.col("to_row")))
    middle = F.col("begin") + F.sum("w").over(Window.partitionBy("block", "from_row").orderBy("r")) - F.col("w") / 2
    rows = rows.withColumn("middle", middle).join(segments, (F.col("shard") == F.col("old")) & (F.col("middle") >= F.col("from_byte")) & (F.col("middle") < F.col("to_byte")))
    parts = rows.groupBy("block", "from_row", "old", "target").agg(F.min("r").alias("first"), (F.max("r") + 1).alias("last"), F.sum("w").alias("bytes"))
    parts = parts.select("block", F.col("first").alias("from_row"), F.col("last").alias("to_row"), "old", F.col("target").alias("shard"), "bytes")
    placed = materialise(_slots(kept.unionByName(parts)), "stretches")
    moved = placed.groupBy("block").agg(F.max(F.col("old") != F.col("shard")).alias("moved"))
    flagged = layout.rows.join(moved.select(F.col("block").alias("m_block__"), "moved"), col(block) == F.col("m_block__")).drop("m_block__")
    path = scratch_path(spark, "moved")
    touched = flagged.filter("moved").drop("moved")
    goes = placed.select(F.col("block").alias("m_block__"), F.col("from_row").alias("m_from__"), F.col("to_row").alias("m_to__"), F.col("shard").alias("in_shard__"))
    touched = touched.join(goes, (col(block) == F.col("m_block__")) & (col(rank) >= F.col("m_from__")) & (col(rank) < F.col("m_to__"))).drop("m_block__", "m_from__", "m_to__")
    touched.write.partitionBy("in_shard__").option("compression", "zstd").parquet(path)
    fresh = spark.read.schema(touched.schema).parquet(path).drop("in_shard__")
    files = flagged.filter("not moved").drop("moved").unionByName(fresh)
    return Layout(files, placed.drop("old"), len(new), layout.hidden)
