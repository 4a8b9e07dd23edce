"""Lookups by key and expansion of parent-child hierarchies."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import has_hash
from millrace.functions.predicates import as_list
from millrace.session import materialise

# A key is hot from this many rows on; a key outside the HOT_KEYS most
# frequent ones holds less than 1/HOT_KEYS of the rows.
HOT_ROWS = 1_000_000
HOT_KEYS = 64
SALTS = 64
# Keys tracked per task when counting; any key above 1/1000 of the rows is found.
_TRACKED = 10_000


def _unused(name: str, *frames: DataFrame) -> str:
    """The name, made longer until no frame has a column called so."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _key_hash(keys: list[str], types: list[str | None]) -> Column:
    """A hash of the join keys, each as the type that both sides have in common."""
    return F.xxhash64(*[F.col(k).cast(t) if t else F.col(k) for k, t in zip(keys, types)])


def _common_types(left: T.StructType, right: T.StructType, keys: list[str]) -> list[str | None] | None:
    """By key the type in which equal keys have equal hashes (None: their own), or None if there is no such type."""
    types = []
    for key in keys:
        a, b = left[key].dataType, right[key].dataType
        if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            types.append("bigint")
        elif a == b and "collate" not in a.simpleString():
            types.append(None)
        elif isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
            types.append("double")
        else:
            return None
    return types


def hot_hashes(df: DataFrame, on, min_rows: int = HOT_ROWS, n: int = HOT_KEYS, types: list[str | None] | None = None) -> DataFrame:
    """One row, ``hot``: the hashes of the most frequent keys with ``min_rows`` rows or more, at most ``n``.

    Only the key columns are read, and every task counts in a sketch of fixed
    size, so nothing is shuffled but the sketches. The counts choose what is
    salted; the result of a join does not depend on them.
    """
    keys = as_list(on)
    hashes = df.select(_key_hash(keys, types or [None] * len(keys)).alias("hash"))
    top = hashes.agg(F.expr(f"approx_top_k(hash, {n}, {_TRACKED})").alias("top"))
    hot = F.transform(F.filter("top", lambda e: e["count"] >= min_rows), lambda e: e["item"])
    return top.select(F.coalesce(hot, F.array().cast("array<bigint>")).alias("hot"))


def salted_join(
    left: DataFrame, right: DataFrame, on, how: str = "inner",
    min_rows: int = HOT_ROWS, n_hot: int = HOT_KEYS, salts: int = SALTS,
) -> DataFrame:
    """An equi-join that spreads the hot keys of ``left`` over ``salts`` tasks.

    Left rows of a hot key get a salt from a hash of the row, the right rows
    of those few keys are repeated once per salt, all other rows have salt 0.
    Rows with a NULL key match nothing and are spread as well. The salt is a
    hash, not a random number, so a task that runs again gives the same rows.
    The hot keys are a scalar subquery of the join's own plan: building it runs
    nothing. Keys whose types have no hash in common are joined without salts.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how}")
    keys = as_list(on)
    types = _common_types(left.schema, right.schema, keys)
    if types is None:
        return left.join(right, keys, how)
    salt, hot_ = _unused("_salt", left, right), _unused("_hot", left, right)
    hot = hot_hashes(left, keys, min_rows, n_hot, types).scalar()
    hashed = [f.name for f in left.schema.fields if has_hash(f.dataType)]
    row_hash = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(salts)).cast("int")
    spread = reduce(or_, [F.col(k).isNull() for k in keys], F.array_contains(hot, _key_hash(keys, types)))
    salted_left = left.withColumn(salt, F.when(spread, row_hash).otherwise(F.lit(0)))
    copies = F.when(F.col(hot_), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn(hot_, F.array_contains(hot, _key_hash(keys, types))).withColumn(salt, F.explode(copies)).drop(hot_)
    return salted_left.join(salted_right, keys + [salt], how).drop(salt)


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "inner", right_is_small: bool = False, **limits) -> DataFrame:
    """``left`` joined with a table of things it refers to.

    The hot keys of ``left`` are salted, as ``salted_join`` says, which takes
    the ``limits`` too; Spark still broadcasts a right side whose size allows.
    A caller who knows that it will saves the reading of ``left``'s keys with
    ``right_is_small``.
    """
    if right_is_small:
        return left.join(right, as_list(on), how)
    return salted_join(left, right, on, how, **limits)


def missing_keys(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """The distinct keys of ``left`` that ``right`` lacks.

    Both sides are reduced to distinct keys before they meet, so a hot key is one row.
    """
    keys = as_list(on)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def resolve_chain(rows: DataFrame, hops: list[tuple[DataFrame, str]], missing: str = "drop", right_is_small: bool = False, **limits) -> DataFrame:
    """``rows`` followed through ``(table, key)`` hops, as tag to version to artifact.

    Each table holds one row per key and the key of the next hop. Rows whose
    key is absent are dropped, kept with NULLs (``"keep"``), or an error when
    the result is computed (``"raise"``). The tables are joined with one another
    from the last hop back, so the rows are joined once. Other arguments are
    those of ``lookup_join``.
    """
    if missing not in ("drop", "keep", "raise"):
        raise ValueError(f"missing must be drop, keep or raise, not {missing}")
    how = "inner" if missing == "drop" else "left"
    found = _unused("_found", rows, *[table for table, _ in hops])
    flags = [f"{found}{place}" for place in range(len(hops))] if missing == "raise" else []
    resolved, key = None, None
    for place, (table, table_key) in reversed(list(enumerate(hops))):
        table = table.withColumn(flags[place], F.lit(True)) if flags else table
        resolved = table if resolved is None else lookup_join(table, resolved, key, how, right_is_small, **limits)
        key = table_key
    result = lookup_join(rows, resolved, key, how, right_is_small, **limits)
    if not flags:
        return result
    lost = reduce(or_, [F.col(flag).isNull() for flag in flags])
    message = F.concat(F.lit("no entry for "), F.to_json(F.struct(*[name for _, name in hops])))
    return result.where(F.when(lost, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(*flags)


def pointing_at(rows: DataFrame, targets: DataFrame, on, right_is_small: bool = False, **limits) -> DataFrame:
    """The rows whose key is among the targets."""
    return lookup_join(rows, targets.select(*as_list(on)).distinct(), on, "left_semi", right_is_small, **limits)


def expand_hierarchy(start: DataFrame, levels: list[tuple[DataFrame, str]], right_is_small: bool = False, **limits) -> DataFrame:
    """All descendants of the start rows: each level is ``(children, parent key)``.

    ``start`` may hold rows of any level; pass the levels below it. The
    children are the large side, so they lead the join.
    """
    rows = start
    for children, parent_key in levels:
        rows = lookup_join(children, rows, parent_key, "inner", right_is_small, **limits)
    return rows


def tree_roots(df: DataFrame, child: str, parent: str, **limits) -> DataFrame:
    """``df`` with ``root`` and ``depth``: the top of each row's tree, however deep it is.

    Every round doubles the way that a row looks up: from its parent to its
    parent's parent, to the one four above, and so on, so a tree of depth d
    takes log d rounds. Rows whose parent is NULL or isn't in the table are
    roots, of depth 0. A child has one parent: one that occurs twice is an
    error, and so is a cycle. A NULL child is a root without descendants.
    Columns ``root`` and ``depth`` of ``df`` are replaced. Popular parents are
    salted, as ``salted_join`` says, which takes the ``limits``.
    """
    ids = df.select(F.col(child).alias("node"), F.col(parent).alias("up"))
    twice = ids.where(F.col("node").isNotNull()).groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"a {child} has several rows")
    known = ids.where(F.col("node").isNotNull()).select(F.col("node").alias("up"), F.lit(True).alias("is_known"))
    rows = lookup_join(ids.where(F.col("node").isNotNull()), known, "up", "left", **limits)
    up = F.when(F.col("is_known"), F.col("up"))
    state = materialise(rows.select("node", up.alias("up"), F.coalesce(up, "node").alias("root"), F.when(up.isNull(), 0).otherwise(1).cast("long").alias("depth")), "tree")
    rounds, most = 0, max(1, state.count()).bit_length() + 1
    while not (open_ := state.where(F.col("up").isNotNull())).isEmpty():
        if rounds == most:
            raise ValueError(f"{child} and {parent} make a cycle")
        rounds += 1
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("root").alias("top"), F.col("depth").alias("more"))
        longer = lookup_join(open_, above, "up", **limits)
        longer = longer.select("node", F.col("next").alias("up"), F.col("top").alias("root"), (F.col("depth") + F.col("more")).alias("depth"))
        state = materialise(state.where(F.col("up").isNull()).unionByName(longer), "tree")
    kept = [c for c in df.columns if c not in ("root", "depth")]
    found = state.select(F.col("node").alias(child), "root", "depth")
    joined = df.select(*[F.col(f"`{c}`") for c in kept]).join(found, child, "left")
    return joined.select(*[F.col(f"`{c}`") for c in kept], "root", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))
