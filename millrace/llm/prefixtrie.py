"""The trie of conversations' turns, by Z-fast tries.

A conversation is a string of turns. A key of 128 bits stands for each of its
prefixes, so prefixes are compared and looked up in one step. Conversations
are dealt into batches of bounded size, and every task inserts one batch into
a Z-fast trie: a compacted node is found by the hash of its handle, the prefix
whose depth is the two-fattest number on the node's edge; a fat binary search
over the depth finds the node where a conversation leaves the trie. All
conversations that are waiting are searched for at once; of those that leave
at one place with the same turn, one is inserted, and the others are searched
for again. Edges are expanded into a node for each turn, and Spark adds up the
nodes of all batches, so what many conversations share is shuffled once a batch.

Long conversations are cut into segments. A segment begins with the key of all
that comes before it, so segments of a level make tries of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, col
from millrace.session import materialise

#: Nodes of a conversation's path that are in one segment.
SEGMENT = 1024
#: Segments of a batch, as a power of two.
BATCH_BITS = 12
_PARTITION_BIT = 33
_KEY = ["depth", "k1", "k2"]


def number_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, a, b, words): turns numbered from 0 within their conversation, as two hashes of role and text.

    Turns are in the order of ``turn``, NULL first; equal ones in that of role
    and text. A NULL role or text is empty. ``words`` are those of the text.
    Rows without a conversation take no part. Rows are dealt by ranges, so a
    conversation may span many tasks.
    """
    said = F.coalesce(col(role), F.lit("")), F.coalesce(col(text), F.lit(""))
    rows = df.filter(col(conversation).isNotNull()).select(col(conversation).cast("long").alias("conv"), col(turn).alias("turn"), said[0].alias("role"), said[1].alias("text"))
    ranged = rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), F.substring("role", 1, 40), F.substring("text", 1, 200))
    ranged = ranged.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    written = ranged.select(
        "conv", F.monotonically_increasing_id().alias("id"), F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "text", "role").alias("b"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    written = materialise(written, "turns").withColumn("part", F.shiftright("id", _PARTITION_BIT))
    stretches = written.groupBy("part", "conv").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return written.join(stretches, ["part", "conv"]).select("conv", (F.col("id") - F.col("first") + F.col("before")).alias("pos"), "a", "b", "words")


def _segments(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(batch, conv, seg, lo, k1, k2, words, last): keys of the nodes on each conversation's path, in segments.

    ``k1`` and ``k2`` hold one key more than ``words``: the first is the node before the
    segment, as whose length ``lo`` counts. The node of depth 0 has the length 1.
    """
    placed = turns.select("conv", (F.col("pos") + 1).alias("depth"), F.xxhash64(F.lit(3), F.col("pos"), "a", "b").alias("a"), F.xxhash64(F.lit(4), "b", F.col("pos"), "a").alias("b"), "words")
    zero = F.lit(0).cast("long")
    placed = placed.union(conversations.select("conv", zero, zero, zero, zero)).withColumn("seg", F.floor(F.col("depth") / SEGMENT))
    gathered = placed.groupBy("conv", "seg").agg(
        F.array_sort(F.collect_list(F.struct("depth", "a", "b", "words"))).alias("nodes"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    keyed = gathered.select(
        (F.shiftright(F.monotonically_increasing_id(), BATCH_BITS)).alias("batch"), "conv", "seg", (F.col("seg") * SEGMENT).alias("lo"),
        *[F.coalesce(F.bit_xor(c).over(earlier), zero).alias(f"from_{c}") for c in "ab"],
        *[F.col(f"nodes.{c}").alias(c) for c in ("a", "b", "words")],
        F.lead("seg").over(Window.partitionBy("conv").orderBy("seg")).isNull().alias("last"),
    )
    schema = "batch long, conv long, seg long, lo long, k1 array<long>, k2 array<long>, words array<long>, last boolean"

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A node's key is the exclusive or of the hashes of all turns up to it, which hold their positions."""
        for batch in batches:
            keys = []
            for c in "ab":
                lists = batch[c]
                keys.append(pa.array([np.bitwise_xor.accumulate(np.concatenate([[start], each])) for start, each in zip(
                    batch[f"from_{c}"].to_numpy(), _lists(lists))], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in ("batch", "conv", "seg", "lo")], *keys, batch["words"], batch["last"]], names=["batch", "conv", "seg", "lo", "k1", "k2", "words", "last"])

    return materialise(keyed.mapInArrow(chained, schema), "segments")


def _lists(array) -> list[np.ndarray]:
    """The lists of an Arrow column as arrays."""
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    ends, values = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
    return [values[s:e] for s, e in zip(ends, ends[1:])]


def two_fattest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number in (a, b] that the highest power of two divides."""
    differ = a ^ b
    for shift in (1, 2, 4, 8, 16, 32):
        differ |= differ >> shift
    return b & ~(differ >> 1)


class ZFastTrie:
    """A trie of strings, given by the keys of their prefixes.

    ``k1`` and ``k2`` are all strings' keys one after the other, ``starts`` where
    each begins; string s has the prefixes of the lengths lo[s] + 1 to hi[s],
    and its first key is that of length lo[s]. Strings of different lo share
    nothing. A compacted node has the prefixes of the lengths ``top`` + 1 to
    ``end`` of the string ``rep``.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray, starts: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.k1, self.k2, self.at, self.lo, self.hi = k1, k2, starts - lo, lo, hi
        self.top, self.end, self.rep = (np.zeros(0, np.int64) for _ in range(3))
        #: Batches that the insertion took.
        self.rounds = 0
        self._index()

    def _keys(self, string: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[string] + length
        return self.k1[at], self.k2[at]

    def _index(self) -> None:
        """Nodes by the keys of their handles, of their first prefixes and of their ends."""
        self.tables = {}
        for name, length in (("handle", two_fattest(self.top, self.end)), ("first", self.top + 1), ("end", self.end)):
            k1, k2 = self._keys(self.rep, length)
            order = np.argsort(k1, kind="stable")
            self.tables[name] = k1[order], k2[order], length[order], order

    def find(self, name: str, string: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The node that has the prefixes of these strings as its handle, first prefix or end; -1 if none has."""
        k1, k2, lengths, nodes = self.tables[name]
        if not len(nodes):
            return np.full(len(string), -1)
        want1, want2 = self._keys(string, length)
        place = np.minimum(np.searchsorted(k1, want1), len(nodes) - 1)
        return np.where((k1[place] == want1) & (k2[place] == want2) & (lengths[place] == length), nodes[place], -1)

    def exits(self, string: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, length): how much of each string the trie has, and the node on whose edge or end that is; -1 above all nodes."""
        a, b = self.lo[string].copy(), self.hi[string].copy()
        node = np.full(len(string), -1)
        left = np.zeros(len(string), bool)  # the string leaves on the edge of the node
        while True:
            open_ = np.flatnonzero((a < b) & ~left)
            if not len(open_):
                break
            middle = two_fattest(a[open_], b[open_])
            hit = self.find("handle", string[open_], middle)
            b[open_] = np.where(hit < 0, middle - 1, b[open_])
            open_, hit = open_[hit >= 0], hit[hit >= 0]
            end = self.end[hit]
            whole = end <= self.hi[string[open_]]
            whole[whole] = self._same(string[open_[whole]], self.rep[hit[whole]], end[whole])
            node[open_] = hit
            a[open_[whole]] = end[whole]
            left[open_[~whole]] = True
        # The next edge may begin as the string goes on, with a handle further down than the string follows it.
        more = np.flatnonzero(~left & (a < self.hi[string]))
        child = self.find("first", string[more], a[more] + 1)
        node[more] = np.where(child >= 0, child, node[more])
        left[more[child >= 0]] = True
        edge = np.flatnonzero(left)
        length = a.copy()
        low, high = np.maximum(self.top[node[edge]], a[edge]), np.minimum(self.end[node[edge]], self.hi[string[edge]])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._same(string[edge], self.rep[node[edge]], middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        length[edge] = low
        return node, length

    def _same(self, one: np.ndarray, two: np.ndarray, length: np.ndarray) -> np.ndarray:
        (a1, a2), (b1, b2) = self._keys(one, length), self._keys(two, length)
        return (a1 == b1) & (a2 == b2)

    def insert(self, strings: np.ndarray) -> None:
        """Insert all strings, in batches that don't meet each other on the way."""
        while len(strings):
            self.rounds += 1
            node, length = self.exits(strings)
            # One string for each place and next key; which one, a hash decides. A string that ends there waits for none.
            goes_on = length < self.hi[strings]
            next1, next2 = self._keys(strings, np.minimum(length + 1, self.hi[strings]))
            last1, _ = self._keys(strings, self.hi[strings])
            order = np.lexsort((last1, next2, next1, length, goes_on))
            first = np.ones(len(order), bool)
            for key in (length, next1, next2, goes_on):
                first[1:] &= key[order[1:]] == key[order[:-1]]
            first[1:] = ~first[1:]
            first[0] = True
            taken = np.zeros(len(strings), bool)
            taken[order[first]] = True
            taken |= ~goes_on
            self._split(node[taken], length[taken])
            new = taken & goes_on
            self.top, self.end = np.concatenate([self.top, length[new]]), np.concatenate([self.end, self.hi[strings[new]]])
            self.rep = np.concatenate([self.rep, strings[new]])
            self._index()
            strings = strings[~taken]

    def _split(self, node: np.ndarray, length: np.ndarray) -> None:
        """Cut the nodes' edges at these lengths, if they aren't the ends."""
        inner = node >= 0
        inner[inner] = (self.top[node[inner]] < length[inner]) & (length[inner] < self.end[node[inner]])
        if not inner.any():
            return
        node, length = np.unique(np.stack([node[inner], length[inner]]), axis=1)
        last = np.append(node[1:] != node[:-1], True)
        first = np.append(True, last[:-1])
        top = np.where(first, self.top[node], np.append(0, length[:-1]))
        self.top, self.end, self.rep = (np.concatenate(p) for p in ((self.top, top), (self.end, length), (self.rep, self.rep[node])))
        self.top[node[last]] = length[last]

    def expand(self, weights: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
        """(length, place, n, least): every prefix as a node, where its key is, the strings through it by weight, and their least label."""
        n, least = np.zeros(len(self.top), np.int64), np.full(len(self.top), np.iinfo(np.int64).max)
        held = self.find("end", np.arange(len(self.hi)), self.hi)
        np.add.at(n, held, weights)
        np.minimum.at(least, held, labels)
        above = self.find("end", self.rep, self.top)
        above[self.top == self.lo[self.rep]] = -1
        for length in np.unique(self.end[above[above >= 0]])[::-1] if len(above) else ():
            # Children's sums are whole before they are handed up: their own ends are further down.
            kids = np.flatnonzero((above >= 0) & (np.where(above >= 0, self.end[above], -1) == length))
            np.add.at(n, above[kids], n[kids])
            np.minimum.at(least, above[kids], least[kids])
        size = self.end - self.top
        which = np.repeat(np.arange(len(size)), size)
        length = self.top[which] + 1 + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        return length, self.at[self.rep[which]] + length, n[which], least[which]


def _flat(table) -> tuple[np.ndarray, ...]:
    """(k1, k2, starts, lo, hi) of a table of segments."""
    k1, k2 = _lists(table["k1"]), _lists(table["k2"])
    sizes = np.array(list(map(len, k1)), np.int64)
    lo = table["lo"].to_numpy()
    return np.concatenate(k1), np.concatenate(k2), np.cumsum(sizes) - sizes, lo, lo + sizes - 1


def build_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations, the root among them.

    ``turns`` has conv, pos, a, b, words as ``number_turns`` gives them, ``pos``
    without gaps from 0; ``conversations`` has each conv once, with turns or not.

    Columns: ``depth``; ``conv_id``, the smallest member; ``parent_conv_id``,
    the parent's (NULL for the root); ``n_convs``, members; ``n_children``;
    ``n_leaves``, childless nodes in the subtree; ``saved_tokens``, the sum over
    the subtree of (members - 1) times the words of a node's last turn;
    ``ends_sha256``, the digest of the sorted ids that end at the node. An empty
    table gives no rows, not even a root.
    """
    bound_batches(turns.sparkSession)
    segments = _segments(turns, conversations)
    local = materialise(segments.select("batch", "conv", "lo", "k1", "k2", "words").groupBy("batch").applyInArrow(
        _local_nodes, "batch long, depth long, k1 long, k2 long, p1 long, p2 long, n long, conv long, words long"), "nodes")
    nodes = local.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("words").alias("words"), F.max(F.struct("p1", "p2")).alias("parent"))
    nodes = materialise(nodes, "trie")
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent.p1").alias("k1"), F.col("parent.p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.drop("parent").join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")
    # Every batch gets what is known of its own nodes.
    known = local.select("batch", *_KEY).join(nodes.select(*_KEY, F.col("conv").alias("owner"), "n_children"), _KEY)
    sums = segments.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(
        _local_sums, "depth long, k1 long, k2 long, saved long, leaves long, parent long, conv long, seg long, more long, leaf long")
    sums = materialise(sums, "sums")
    # What a long conversation's later segments add to the nodes of its earlier ones.
    totals = sums.filter("conv IS NOT NULL").select("conv", "seg", "more", "leaf")
    later = Window.partitionBy("conv").orderBy("seg").rowsBetween(1, Window.unboundedFollowing)
    totals = totals.select("conv", "seg", F.sum("more").over(later).alias("more"), F.sum("leaf").over(later).alias("leaf")).filter("more > 0 OR leaf > 0")
    long_ = segments.filter("NOT last").join(totals, ["conv", "seg"]).select("seg", "more", "leaf", F.posexplode(F.arrays_zip("k1", "k2")).alias("i", "key")).filter("i > 0")
    long_ = long_.select((F.col("seg") * SEGMENT + F.col("i") - 1).alias("depth"), "key.k1", "key.k2", F.col("more").alias("saved"), F.col("leaf").alias("leaves"), F.lit(None).cast("long").alias("parent"))
    added = sums.filter("conv IS NULL").select(*_KEY, "saved", "leaves", "parent").union(long_)
    added = added.groupBy(*_KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.max("parent").alias("parent_conv_id"))
    ends = segments.filter("last").select(
        (F.col("seg") * SEGMENT + F.size("words") - 1).alias("depth"), F.element_at("k1", -1).alias("k1"), F.element_at("k2", -1).alias("k2"), "conv")
    digests = ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "depth", "conv").mapInArrow(_ends, "depth long, k1 long, k2 long, ends_sha256 string")
    return nodes.join(added, _KEY).join(digests, _KEY, "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def _local_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one batch's trie, and the nodes before its segments with no members."""
    k1, k2, starts, lo, hi = _flat(table)
    conv = table["conv"].to_numpy()
    # Equal strings are one, with a weight.
    last = starts + hi - lo
    order = np.lexsort((conv, k2[last], k1[last], hi))
    new = np.ones(len(order), bool)
    for key in (hi, k1[last], k2[last]):
        new[1:] &= key[order[1:]] == key[order[:-1]]
    new[1:] = ~new[1:]
    new[0] = True
    first = np.flatnonzero(new)
    weights, string = np.diff(np.append(first, len(order))), order[first]
    trie = ZFastTrie(k1, k2, starts[string], lo[string], hi[string])
    trie.insert(np.arange(len(string)))
    length, place, n, least = trie.expand(weights, conv[string])
    words = np.concatenate([np.concatenate([[0], w]) for w in _lists(table["words"])])
    before = np.unique(np.stack([lo, k1[starts], k2[starts]])[:, lo > 0], axis=1)
    none = np.zeros(before.shape[1], np.int64)
    columns = [
        np.concatenate([length, before[0]]) - 1, np.concatenate([k1[place], before[1]]), np.concatenate([k2[place], before[2]]),
        np.concatenate([k1[place - 1], none]), np.concatenate([k2[place - 1], none]), np.concatenate([n, none]),
    ]
    known = np.concatenate([np.ones(len(n), bool), none.astype(bool)])
    columns = [pa.array(c) for c in columns]
    for k in (3, 4):
        columns[k] = pa.array(columns[k].to_numpy(), mask=~known)
    columns += [pa.array(np.concatenate([least, none]), mask=~known), pa.array(np.concatenate([words[place], none]), mask=~known)]
    return pa.table([pa.array(np.full(len(known), table["batch"][0].as_py()))] + columns, names=["batch", "depth", "k1", "k2", "p1", "p2", "n", "conv", "words"])


def _local_sums(table: pa.Table, known: pa.Table) -> pa.Table:
    """What a batch adds to each of its nodes, and what each of its segments adds to earlier ones of its conversation.

    A node's owner is its smallest member. A conversation saves the words of
    the nodes on its path that it doesn't own, which are the first ones.
    """
    k1, k2, starts, lo, hi = _flat(table)
    conv, last = table["conv"].to_numpy(), table["last"].to_numpy(zero_copy_only=False).astype(bool)
    keys = {c: known[c].to_numpy() for c in ("depth", "k1", "k2", "owner", "n_children")}
    order = np.argsort(keys["k1"], kind="stable")
    sizes = hi - lo + 1
    node = order[np.searchsorted(keys["k1"][order], k1)]
    own = np.ones(len(k1), bool)
    own[starts] = False  # the node before a segment is none of its nodes
    depth = np.repeat(lo - starts, sizes) + np.arange(len(k1)) - 1
    checked = own | (depth >= 0)
    if not ((keys["k2"][node] == k2) & (keys["depth"][node] == depth))[checked].all():
        raise ValueError("two prefixes have the same key")
    words = np.concatenate([np.concatenate([[0], w]) for w in _lists(table["words"])])
    saved = np.where(own & (keys["owner"][node] != np.repeat(conv, sizes)), words, 0)
    # Sums from each place to the end of its segment.
    total = np.cumsum(saved)
    end = starts + sizes - 1
    rest = np.repeat(total[end], sizes) - total + saved
    tip = node[end]
    leaf = (last & (keys["n_children"][tip] == 0) & (keys["owner"][tip] == conv)).astype(np.int64)
    size = known.num_rows
    sum_saved, sum_leaf, parent = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
    at = np.flatnonzero(own)
    np.add.at(sum_saved, node[at], rest[at])
    np.add.at(sum_leaf, node[at], np.repeat(leaf, sizes)[at])
    parent[node[at]] = node[at - 1]
    held = np.flatnonzero(np.bincount(node[at], minlength=size))
    root = keys["depth"][held] == 0
    n, none = len(held), pa.nulls(len(conv), pa.int64())
    nodes = [pa.array(keys[c][held]) for c in ("depth", "k1", "k2")] + [pa.array(sum_saved[held]), pa.array(sum_leaf[held]), pa.array(keys["owner"][parent[held]], mask=root)]
    parts = [pa.array(conv), table["seg"].combine_chunks(), pa.array(rest[starts + 1]), pa.array(leaf)]
    columns = [pa.concat_arrays([c, none]) for c in nodes] + [pa.concat_arrays([pa.nulls(n, pa.int64()), c.cast(pa.int64())]) for c in parts]
    return pa.table(columns, names=["depth", "k1", "k2", "saved", "leaves", "parent", "conv", "seg", "more", "leaf"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids from rows in order. Only one digest's state is held, however many ids there are."""
    key, digest = None, None

    def out(rows: list) -> pa.RecordBatch:
        keys = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*keys, pa.array([r[1] for r in rows], pa.string())], names=["depth", "k1", "k2", "ends_sha256"])

    for batch in batches:
        columns = [batch[c].to_numpy() for c in ("depth", "k1", "k2", "conv")]
        new = np.ones(batch.num_rows, bool)
        for c in columns[:3]:
            new[1:] &= c[1:] == c[:-1]
        new[1:] = ~new[1:]
        begins, done = np.flatnonzero(new), []
        for s, e in zip(begins, np.append(begins[1:], batch.num_rows)):
            here, ids = tuple(int(c[s]) for c in columns[:3]), ",".join(map(str, columns[3][s:e].tolist())).encode()
            if here == key:
                digest.update(b"," + ids)
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = here, hashlib.sha256(ids)
        if done:
            yield out(done)
    if key is not None:
        yield out([(key, digest.hexdigest())])
