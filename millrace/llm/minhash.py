"""Near-duplicates by the Jaccard similarity of word shingles.

The SimHash of a text's shingle set goes through the binary tries of
``simhash``, which name the pairs that are looked at; whether a pair links is
decided by the exact similarity of its shingle sets, in a Spark join. Bands of a
fingerprint's own bits are the buckets for three bits. At a similarity of 0.8
ten bits differ and up to 24, more than such bands carry; there the buckets are
MinHash bands, and a trie in each names pairs within growing numbers of bits.
It names those that join components, not all, so a large group of copies costs
a few comparisons a member and not one a pair. Last come those pairs of a bucket
that no chain of links has joined yet: of these, only such are compared as share
one of their rarest shingles, so unlike texts that share a passage don't all
meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.common import bound_batches, col, unused
from millrace.llm.simhash import connected
from millrace.session import materialise

#: A pair of similarity s shares one of BANDS keys with a chance of 1 - (1 - s ** ROWS) ** BANDS: 0.9999 at 0.8.
BANDS, ROWS = 30, 6
#: Fingerprints of a bucket in one trie; a larger bucket has several, dealt in SPREADS ways over the keys.
CHUNK, SPREADS = 256, 4
#: Members of a bucket that are in each of its tries, so that these meet.
PIVOTS = 3
#: Bits in which fingerprints that link may differ: anywhere, and in the tries of a bucket, one after the other.
NEAR, BUDGETS = 3, (3, 12, 24)
_SHINGLES_AT_ONCE = 1 << 12
_random = np.random.Generator(np.random.PCG64(42))
_FLIPS, _FACTORS, _WEIGHTS = (_random.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(k) for k in (0, 1, 1))


def shingles(text: str | None, words: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct 64-bit hashes of a text's runs of ``words`` words, in order; that of all words if there are fewer, none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not tokens:
        return np.zeros(0, np.uint64)
    joined, ends, at = b" ".join(tokens), [], -1
    for token in tokens:
        at += len(token) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[min(words, len(tokens)) - 1:])], np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band, which two sets share if the least hashes of the band's orders are the same."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), _SHINGLES_AT_ONCE):
        part = hashes[k:k + _SHINGLES_AT_ONCE, None]
        np.minimum(least, ((part ^ _FLIPS) * _FACTORS).min(axis=0), out=least)
    return (least * _WEIGHTS).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64).view(np.int64)


def signatures(text: Column, words: int = 5) -> Column:
    """``struct<print binary, keys array<long>, fingerprint long>``: the digest of a text's shingle set, its bands' keys and its SimHash."""

    @F.arrow_udf("struct<print binary, keys array<long>, fingerprint long>")
    def signed(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, words) for t in texts.to_pylist()]
        prints = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        hashed = pa.array(np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64))
        return pa.StructArray.from_arrays([prints, _lists([band_keys(s) for s in sets]), hashed], names=["print", "keys", "fingerprint"])

    return signed(text)


def shingle_sets(text: Column, words: int = 5) -> Column:
    """The distinct shingle hashes of a text column, as signed longs."""

    @F.arrow_udf("array<long>")
    def hashed(texts: pa.Array) -> pa.Array:
        return _lists([shingles(t, words).view(np.int64) for t in texts.to_pylist()])

    return hashed(text)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of ``least`` or more."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both, sizes = pairs.join(one, "a").join(two, "b"), (F.size("set_a"), F.size("set_b"))
    both = both.filter(F.least(*sizes) / F.greatest(*sizes) >= least)
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.filter(common / (sizes[0] + sizes[1] - common) >= least).select("a", "b")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def rare_pairs(sets: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs of nodes of different roots that can have a Jaccard similarity of ``least`` or more.

    ``sets`` has ``node``, ``root`` and ``set``. Two such sets share ``least`` of
    the larger one's shingles or more, so each has one that both have among the
    rarest that are left when these are taken away; they meet on it. What many
    unlike texts share is frequent and comes last, so it brings no pairs, and a
    pair is left out where too few shingles follow the one it meets on.
    Shingles that no other set has are rarest of all and need no looking at.
    """
    shingles_ = sets.select("node", F.explode("set").alias("shingle"))
    common = shingles_.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = shingles_.join(common, "shingle").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    size = F.size("set")
    needed = F.ceil(size * F.lit(least) - F.lit(1e-9)).cast("int")
    first = ranked.join(sets.select("node", "root", size.alias("size"), needed.alias("needed")), "node").filter(F.size("ranked") >= F.col("needed"))
    rarest = F.slice("ranked", F.lit(1), F.size("ranked") - F.col("needed") + 1).getField("shingle")
    first = first.select("node", "root", "size", (F.col("size") - F.size("ranked")).alias("alone"), F.posexplode(rarest).alias("place", "shingle"))
    # How many shingles from this one on: no more can be common where it is the first that is.
    first = first.select("node", "root", "size", "shingle", (F.col("size") - F.col("alone") - F.col("place")).alias("rest"))
    first = materialise(first, "rarest")
    one, two = (first.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "size", "rest")]) for side in "ab")
    met = one.join(two, "shingle").filter((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")))
    enough = F.least("rest_a", "rest_b") >= (F.col("size_a") + F.col("size_b")) * F.lit(least / (1 + least)) - F.lit(1e-9)
    near = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * F.lit(least) - F.lit(1e-9)
    return met.filter(near & enough).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def near_prints(keyed: DataFrame) -> DataFrame:
    """Pairs of nodes (a, b) that span what links of fingerprints within ``NEAR`` bits reach in the buckets of their bits."""
    prints = materialise(keyed.groupBy("fingerprint").agg(F.min("node").alias("first")), "prints")
    links = simhash.links(prints.select("fingerprint"), prints.count(), NEAR)
    ends = [prints.select(F.col("fingerprint").alias(side), F.col("first").alias(f"node_{side}")) for side in "ab"]
    linked = links.join(ends[0], "a").join(ends[1], "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return linked.union(keyed.join(prints, "fingerprint").filter("node <> first").select("node", "first"))


def bucket_pairs(buckets: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs of nodes (a, b) that the tries of the buckets name.

    ``buckets`` has ``key``, ``node``, ``fingerprint`` and ``chunks``, the
    number of the bucket's tries; ``shared`` has ``key``, ``chunks`` and
    ``pivots``, which are in each of the tries if there are several.
    """
    chunk = F.pmod(F.xxhash64("node", F.pmod("key", F.lit(SPREADS))), F.col("chunks")).cast("int")
    dealt = buckets.select("key", chunk.alias("chunk"), "node", "fingerprint")
    pivots = shared.filter("chunks > 1").select("key", "pivots", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    members = dealt.unionByName(pivots.select("key", "chunk", F.inline("pivots")))
    return simhash.group_pairs(members, buckets.count(), BUDGETS)


def similar_links(keyed: DataFrame, texts: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """(node, root) of all nodes with links, root the smallest node that chains of links reach.

    ``keyed`` has the columns ``node`` (long, distinct), ``keys`` and
    ``fingerprint``; ``texts`` has ``node`` and ``text``, of these nodes and any
    others. Pairs that tries of fingerprints name are held against ``least`` by
    the exact similarity of the two texts, then every other pair of nodes that
    shares a key, unless links that are known by then join it already or the
    rarest shingles of both rule it out.
    """
    buckets = keyed.select("node", "fingerprint", F.explode("keys").alias("key"))
    firsts = [F.min_by(F.struct("node", "fingerprint"), F.xxhash64("node", F.lit(k))) for k in range(PIVOTS)]
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array(*firsts).alias("pivots")).filter("n > 1")
    shared = materialise(shared.select("key", F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks"), "pivots"), "shared")
    buckets = materialise(buckets.join(shared.select("key", "chunks"), "key"), "buckets")
    pairs = near_prints(keyed.select("node", "fingerprint")).union(bucket_pairs(buckets, shared))
    pairs = materialise(pairs.select(*_pairs(F.col("a"), F.col("b"))).filter("a <> b").distinct(), "pairs")
    nodes = buckets.select("node").union(pairs.select(F.explode(F.array("a", "b")))).distinct()
    sets = texts.join(nodes, "node", "left_semi").select("node", shingle_sets(col("text"), words).alias("set"))
    sets = materialise(sets, "sets")
    found = materialise(_similar(pairs, sets, least), "similar")
    roots = connected(found)
    # What is left are pairs of a bucket that no chain joins yet: of members of different components.
    members = buckets.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = members.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("key")
    nodes = materialise(members.join(mixed, "key", "left_semi").select("node", "root").distinct(), "members")
    rest = rare_pairs(sets.join(nodes, "node"), least).join(pairs, ["a", "b"], "left_anti")
    more = materialise(_similar(rest, sets, least), "similar")
    if more.isEmpty():
        return roots
    return connected(found.union(more))


def keep_first(df: DataFrame, text: str = "text", order: str = "doc_id", words: int = 5, least: float = 0.8) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``df``.

    Rows link when the sets of their runs of ``words`` words have a Jaccard
    similarity of ``least`` or more, and a group is all that links reach. Texts
    without words, NULL among them, are one group. The row with the smallest
    ``order`` stays (NULLs last); of rows that tie, one. Nothing else is dropped.
    """
    bound_batches(df.sparkSession)
    row, sign, stays = unused(df, "row__", "sign__", "stays__")
    # Rows get an id when they are written, so one of several equal rows can be told.
    fixed = materialise(df.select("*", signatures(col(text), words).alias(sign), F.monotonically_increasing_id().alias(row)), "documents")
    # Rows of equal sets are one node, called by the row that would stay of them.
    member = F.struct(col(order).isNull(), col(order), col(row).alias("node"))
    own = [col(sign)[n].alias(n) for n in ("keys", "fingerprint")]
    groups = fixed.groupBy(col(sign)["print"]).agg(F.min(F.struct(member.alias("member"), *own)).alias("first"))
    groups = materialise(groups.select("first.member", "first.keys", "first.fingerprint", "first.member.node"), "groups")
    roots = similar_links(groups.select("node", "keys", "fingerprint"), fixed.select(col(row).alias("node"), col(text).alias("text")), words, least)
    named = groups.select("member", "node").join(roots, "node", "left").select("member", F.coalesce("root", "node").alias("root"))
    stay = named.groupBy("root").agg(F.min("member").alias("member")).select(F.col("member.node").alias(stays))
    return fixed.join(stay, col(row) == col(stays), "left_semi").select(*[col(c) for c in df.columns])
