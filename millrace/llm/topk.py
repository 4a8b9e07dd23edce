"""Exact top-k inner products in three phases with a uniform threshold.

A vector's dimensions are dealt to nodes, rows that hold their own slice of the
vectors and see no other, so a score is a sum of one part from each node. First
every node lists each query's best parts; nodes look up the few vectors listed,
and the k-th best score is a floor for the query. A vector that makes the top k
has a part of at least floor / nodes at some node: second, every node lists the
parts from that cutoff on. Parts that are missing are below the cutoff, which
bounds the whole score from above; third, nodes look up the parts that are
missing of what the bound leaves, and what turns out below the floor stays
there. Equal vectors are one, with their smallest ids. Vectors are met in
blocks, never pair by pair in a join, and what a node says of two blocks is one
row of lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import bound_batches, col
from millrace.session import materialise

NODES = 2
#: Queries and vectors of a tile; vectors of a large table come in blocks of up to ``MORE`` times as many.
QUERY_BLOCK, BLOCK, MORE = 1024, 8192, 2
#: Scores that are held at once.
CELLS = 1 << 23
#: A node's list for a query holds so many times the vectors that are looked for; the more, the higher the floor.
LISTED = 4
#: Kinds of numbers, and the bound below which each holds all whole numbers.
_EXACT = ((np.float32, 1 << 24), (np.float64, 1 << 53))


def whole_vectors(df: DataFrame, vector: str = "embedding", scale: float = 64.0) -> Column:
    """The components as floor(scale * x), x as double; NULL if the vector or a component is NULL or not finite."""
    x = col(vector).cast("array<double>")
    # x - x is 0 for finite numbers only.
    usable = col(vector).isNotNull() & F.forall(x, lambda v: F.coalesce((v - v) == 0.0, F.lit(False)))
    return F.when(usable, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def scores(queries: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Integer inner products of some queries after the other, with the number of the first of these.

    By floating point where that is exact, and as such, else by whole numbers.
    """
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    kind = next((kind for kind, bound in _EXACT if top < bound), np.int64)
    step = max(1, CELLS // max(1, len(vectors)))
    held = vectors.T.astype(kind)
    for n in range(0, len(queries), step):
        yield n, queries[n : n + step].astype(kind) @ held


def _slices(width: int, nodes: int) -> list[tuple[int, int]]:
    """Each node's dimensions, as (from, to)."""
    edges = [width * n // nodes for n in range(nodes + 1)]
    return list(zip(edges, edges[1:]))


def _blocks(df: DataFrame, size: int, label: str, slices: list[tuple[int, int]], more: int = 1) -> tuple[DataFrame, int]:
    """(node, block, ids, vectors) with ``size`` vectors a block about, and the number of blocks.

    From 16 blocks on these get larger, up to ``more`` times, so that others are repeated for fewer. A block's vectors are in the order of their smallest members at every node; a node's slices of them are one list.
    """
    count = df.count()
    blocks = max(1, -(-count // min(size * more, max(size, count // 16))))
    parts = F.array(*[F.struct(F.lit(n).alias("node"), F.slice("vec", a + 1, b - a).alias("part")) for n, (a, b) in enumerate(slices)])
    dealt = df.select("first", "id", F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int").alias("block"), F.inline(parts))
    dealt = dealt.groupBy("node", "block").agg(F.array_sort(F.collect_list(F.struct("first", "id", "part"))).alias("all"))
    dealt = dealt.select("node", "block", F.transform("all", lambda x: x["id"]).alias("ids"), F.flatten(F.transform("all", lambda x: x["part"])).alias("vectors"))
    return materialise(dealt, label), blocks


def _met(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Both sides joined where they are dealt to, without the driver.

    Spark takes a table's size from its compressed files, before blocks are repeated and lists unpacked, and broadcasts
    through the driver what seems small: whole numbers of a few bits are 64 in a row.
    """
    return left.join(right.hint("merge"), on, how)


def _tiles(queries: DataFrame, vectors: DataFrame, blocks: int, nodes: int) -> DataFrame:
    """At every node, each block of queries beside each block of vectors: block numbers, not rows, are paired."""
    q = queries.select("node", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c != "node"], F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    # With room to spare few tasks get two blocks.
    return _met(q.repartition(4 * nodes * blocks, "node", "block"), vectors, ["node", "block"])


def _over_rows(df: DataFrame, lists, schema: str) -> DataFrame:
    """``lists(value)`` of each row, batches of columns; ``value(name)`` is the row's list or number."""
    made = T.StructType.fromDDL(schema)
    names, kinds = made.names, [to_arrow_type(f.dataType) for f in made.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):

                def value(name: str):
                    cell = batch[name][k]  # noqa: B023
                    if not isinstance(cell, pa.ListScalar):
                        return cell.as_py()
                    return cell.values if pa.types.is_struct(cell.type.value_type) else cell.values.to_numpy(zero_copy_only=False)

                for out in lists(value):
                    if len(out[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=names)

    return df.mapInArrow(run, made)


def _joined(sent: pa.StructArray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of lists (at, parts): each distinct place, the sum of its parts, and the places of every list among these."""
    at, parts = [[x.values.to_numpy(zero_copy_only=False) for x in sent.field(name)] for name in ("at", "parts")]
    places, where = np.unique(np.concatenate(at), return_inverse=True)
    sums = np.zeros(len(places), np.int64)
    np.add.at(sums, where, np.concatenate(parts))
    return places, sums, np.split(where, np.cumsum([len(x) for x in at])[:-1])


def top_k(df: DataFrame, queries: Column, k: int, id: str = "vec_id", vector: str = "vec", nodes: int = NODES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows, ties to the smaller id.

    ``vector`` holds whole numbers; a NULL one takes no part, and shorter ones
    end in zeros. ``queries`` says which rows ask. All rows are candidates but
    the query's own id. Repeated rows count as often as they come, except those
    of the query's own id. Fewer than k others are all returned; an empty table
    gives no rows. Scores are exact while they fit a long.
    """
    bound_batches(df.sparkSession)
    rows = df.select(col(id).alias("id"), col(vector).alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks")).filter("vec is not null and id is not null")
    rows = materialise(rows, "vectors")
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))))
    # Of equal vectors only the k + 1 smallest ids can be in a list; row_number below a bound is cut before the shuffle.
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    members = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    members = members.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("members"))
    # A class has a number of its own, as an id may come with several vectors.
    members = materialise(members.select("vec", "members", F.element_at("members", 1).alias("first"), F.monotonically_increasing_id().alias("id")), "classes")
    # A query class asks for one more, as its own row may be among the best.
    wanted = _met(rows.filter("asks").select("vec").distinct(), members, "vec")
    slices, need = _slices(width, nodes), k + 1
    vectors, blocks = _blocks(members, BLOCK, "blocks", slices, MORE)
    asking, _ = _blocks(wanted, QUERY_BLOCK, "queries", slices)
    entry = "node int, q_block int, block int, at array<int>, parts array<long>"
    tile = ["q_block", "block"]

    def matrices(value) -> tuple[np.ndarray, np.ndarray]:
        """A node's slices of the queries and of the vectors of a tile."""
        a, b = slices[value("node")]
        return value("q_vectors").reshape(len(value("q_ids")), b - a), value("vectors").reshape(len(value("ids")), b - a)

    # A place in a tile is a query's place times the number of vectors, plus the vector's.
    def look_up(value):
        """Adds a node's parts to the sums from ``done`` on; of the first ``whole``, those below the floor are left out."""
        (q, v), at, sums, done, whole = matrices(value), value("at"), value("parts").copy(), value("done"), value("whole")
        for n in range(done, len(at), 65536):
            x = at[n : n + 65536]
            sums[n : n + 65536] += np.einsum("ij,ij->i", q[x // len(v)], v[x % len(v)])
        stays = np.ones(len(at), bool)
        stays[:whole] = sums[:whole] >= value("q_floors")[at[:whole] // len(v)]
        if stays.any():
            yield [value("node")], [value("q_block")], [value("block")], [at[stays]], [sums[stays]]

    def best(value):
        ids, places, whole, _ = value("ids"), *_joined(value("sent"))
        # By query, best scores first, then by smallest members; the first ``need`` of each query stay.
        query = places // len(ids)
        order = np.lexsort((places, -whole, query))
        query, starts = query[order], np.searchsorted(query, query[order])
        chosen = np.arange(len(order)) - starts < need
        yield value("q_ids")[query[chosen]], ids[places[order][chosen] % len(ids)], whole[order][chosen]

    def scored(places: DataFrame, asking: DataFrame) -> DataFrame:
        """(query, id, score) of the best in each tile: every node looks up its parts of ``places``, which are then summed."""
        q = asking.select("node", F.col("block").alias("q_block"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "floors")])
        found = _over_rows(_met(_met(places, q, ["node", "q_block"]), vectors, ["node", "block"]), look_up, entry)
        tiles = found.groupBy(*tile).agg(F.collect_list(F.struct("node", "at", "parts")).alias("sent"))
        tiles = _met(_met(tiles, q.filter("node = 0").select("q_block", "q_ids"), "q_block"), vectors.filter("node = 0").select("block", "ids"), "block")
        return _over_rows(tiles, best, "query long, id long, score long")

    def best_parts(value):
        qids, size = value("q_ids"), len(value("ids"))
        n = min(need, size)
        for first, parts in scores(*matrices(value)):
            top = np.argpartition(parts, size - n, axis=1)[:, size - n :]
            at = top + np.arange(first, first + len(parts))[:, None] * size
            here = [np.full(top.size, value(x), np.int32) for x in ("node", "q_block", "block")]
            yield *here, np.repeat(qids[first : first + len(parts)], n), at.ravel().astype(np.int32), np.take_along_axis(parts, top, 1).ravel().astype(np.int64)

    # Phase 1: each node's best parts; the few vectors listed are scored, and the k-th best score is the floor. A class counts once for each member.
    listed = _over_rows(_tiles(asking, vectors, blocks, nodes), best_parts, "node int, q_block int, block int, query long, at int, part long")
    place = F.row_number().over(Window.partitionBy("node", "query").orderBy(F.desc("part"), "block", "at"))
    listed = listed.withColumn("place", place).filter(F.col("place") <= LISTED * need).groupBy(*tile).agg(F.array_sort(F.collect_set("at")).alias("at"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node")
    listed = listed.select(everywhere, *tile, F.lit(0).alias("done"), F.lit(0).alias("whole"), "at", F.transform("at", lambda _: F.lit(0).cast("long")).alias("parts"))
    counted = _met(scored(listed, asking.withColumn("floors", F.array().cast("array<long>"))), members.select("id", F.size("members").alias("n")), "id")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    counted = counted.withColumn("upto", F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, 0)))
    floors = counted.groupBy("query").agg(F.max(F.when(F.col("upto") >= need, F.col("score"))).alias("floor"))
    # Each query's block learns its floors; none where there are too few others: everything counts then.
    held = _met(asking.filter("node = 0").select("block", F.posexplode("ids").alias("at", "query")), floors, "query", "left")
    held = held.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("floor", F.lit(-(1 << 62))).alias("floor")))).alias("all"))
    floors = materialise(held.select("block", F.transform("all", lambda x: x["floor"]).alias("floors")), "floors")
    asking = _met(asking, floors, "block")

    # Phase 2: at each node, the parts from the cutoff on. Rounded, a cutoff that a kind of number can't hold stays beyond all parts.
    def sufficient(value):
        size, floors, found = len(value("ids")), value("q_floors"), []
        for first, parts in scores(*matrices(value)):
            least = -(-floors[first : first + len(parts), None] // nodes)
            at = np.flatnonzero(parts >= least.astype(parts.dtype))
            found.append(((at + first * size).astype(np.int32), parts.ravel()[at].astype(np.int64)))
        at, parts = (np.concatenate(x) for x in zip(*found))
        if len(at):
            yield [value("node")], [value("q_block")], [value("block")], [size], [floors], [at], [parts]

    # A node that sent nothing has less than the cutoff: at most the cutoff less one.
    def open_places(value):
        floor, size, sent = value("q_floors"), value("size"), value("sent")
        places, known, lists = _joined(sent)
        seen = np.zeros((nodes, len(places)), bool)
        for node, where in zip(sent.field("node").to_pylist(), lists):
            seen[node, where] = True
        least, left = floor[places // size], nodes - seen.sum(0)
        open_ = known + left * (-(-least // nodes) - 1) >= least
        # Sums go with the first node that is asked, whole ones with node 0: ``done`` of these, then those that one part makes whole.
        carrier = np.where(left > 0, np.argmin(seen, 0), 0)
        for node in range(nodes):
            lists = [np.flatnonzero(open_ & x) for x in ((left == 0) & (node == 0), (left == 1) & ~seen[node], (left > 1) & ~seen[node])]
            chosen, done = np.concatenate(lists), len(lists[0])
            if len(chosen):
                parts = np.where(carrier[chosen] == node, known[chosen], 0)
                yield [node], [value("q_block")], [value("block")], [done], [done + len(lists[1])], [places[chosen]], [parts]

    # Lists bring the few numbers that are needed beside them, as they are what is large here.
    entries = _over_rows(_tiles(asking, vectors, blocks, nodes), sufficient, entry.replace("at array", "size int, q_floors array<long>, at array"))
    sent = entries.groupBy(*tile).agg(F.first("size").alias("size"), F.first("q_floors").alias("q_floors"), F.collect_list(F.struct("node", "at", "parts")).alias("sent"))

    # Phase 3: nodes look up the parts that are missing.
    left = _over_rows(sent, open_places, entry.replace("at array", "done int, whole int, at array"))
    resolved = materialise(scored(left, asking), "scores")
    resolved = _met(resolved, members.select("id", "first", "members"), "id")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first", "id"))
    ranked = resolved.withColumn("place", place).filter(F.col("place") <= need)
    listed = ranked.select("query", "score", F.explode("members").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # A list holds k + 1 classes at most, each with k + 1 ids at most; every asking row takes its class's, without itself.
    listed = listed.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= need)
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    lists = _met(lists, members.select(F.col("id").alias("query"), "vec"), "query")
    asked = rows.filter("asks").select("id", "vec").distinct()
    each = _met(asked, lists, "vec").select("id", F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("id")), 1, k).alias("best"))
    each = each.select(F.col("id").alias("query_id"), F.posexplode("best").alias("at", "b"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").cast("long").alias("vec_id"), F.col("b.score").cast("long").alias("score"))
