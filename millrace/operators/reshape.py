"""Columns to rows and back, nested JSON to leaves, maps turned round."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import as_array, unused
from millrace.functions.predicates import as_list
from millrace.operators.numbering import number_rows

# A group is collected in chunks of this many rows, so no row grows with its group.
CHUNK_ROWS = 1_000


def columns_to_rows(df: DataFrame, columns: list[str], position: str | None = None) -> DataFrame:
    """Parallel arrays become one row per position; arrays of unequal length are an error."""
    same_size = reduce(and_, [F.size(c) == F.size(columns[0]) for c in columns], F.lit(True))
    checked = F.when(same_size, F.arrays_zip(*columns)).otherwise(
        F.raise_error(F.lit(f"arrays of unequal length: {', '.join(columns)}"))
    )
    kept = [c for c in df.columns if c not in columns]
    number, row = unused(df, "_position", "_row")
    rows = df.select(*kept, F.posexplode(checked).alias(number, row))
    values = [F.col(row).getField(c).alias(c) for c in columns]
    place = [F.col(number).alias(position)] if position else []
    return rows.select(*kept, *place, *values)


def chunked_rows(df: DataFrame, by, order_by, columns: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(by.., chunk, rows)``: the rows of each group as arrays of at most ``chunk_rows`` structs.

    A struct starts with the row's position in the whole group, from 0, and
    each array is in that order. The first field is ``_position``, or longer
    where a column is called so.
    """
    groups = as_list(by)
    position = unused(df, "_position")[0]
    numbered = number_rows(df.select(*dict.fromkeys([*groups, *_names(order_by), *columns])), groups, order_by, position, 0)
    # Positions differ, so the order of the structs is that of their first field.
    # Maps and variants have no order, so then the positions are compared explicitly.
    unordered = [c for c in columns if isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    row = F.struct(position, *columns)
    collected = F.collect_list(row)
    by_position = lambda a, b: F.signum(a[position] - b[position]).cast("int")
    in_order = F.array_sort(collected, by_position) if unordered else F.array_sort(collected)
    return (
        numbered.withColumn("chunk", F.expr(f"{position} div {int(chunk_rows)}"))
        .groupBy(*groups, "chunk")
        .agg(in_order.alias("rows"))
    )


def _names(order_by) -> list[str]:
    return [item.strip().partition(" ")[0].lstrip("-") for item in as_list(order_by)]


def rows_to_columns(df: DataFrame, by, order_by, columns: list[str] | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One array per column, in order, per group and chunk of at most ``chunk_rows`` rows."""
    groups = as_list(by)
    names = columns or [c for c in df.columns if c not in groups]
    chunks = chunked_rows(df, groups, order_by, names, chunk_rows)
    return chunks.select(*groups, "chunk", *[F.col("rows").getField(c).alias(c) for c in names])


def wrap_scalars(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that are no arrays become one-element arrays."""
    return df.withColumns({c: as_array(F.col(c), df.schema[c].dataType) for c in columns})


def invert_map(column: Column) -> Column:
    """Values to keys; of equal values the last entry counts, and NULL values, which can be no keys, are left out."""
    entries = F.filter(F.map_entries(column), lambda entry: entry.value.isNotNull())
    # In order of value and then place, the last of each run of equal values counts.
    placed = F.array_sort(F.transform(entries, lambda entry, i: F.struct(entry.value.alias("value"), i.alias("place"), entry.key.alias("key"))))
    last = F.filter(placed, lambda entry, i: F.coalesce(F.get(placed, i + 1)["value"] != entry["value"], F.lit(True)))
    return F.map_from_entries(F.transform(last, lambda entry: F.struct(entry["value"], entry["key"])))


def invert_pairs(df: DataFrame, key: str, value: str, order_by) -> DataFrame:
    """A table of pairs turned round: per value the key that comes last in the order."""
    order = F.struct(*as_list(order_by))
    return df.groupBy(value).agg(F.max_by(key, order).alias(key))


def json_depth(text: Column) -> Column:
    """How deep objects and arrays nest in a JSON text; 0 for a scalar."""
    unescaped = F.regexp_replace(text, r"(?s)\\.", "")
    brackets = F.regexp_replace(unescaped, r'"[^"]*"|[^\[\]{}"]+', "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("deepest"))

    def step(state: Column, bracket: Column) -> Column:
        now = state.now + F.when(bracket.isin("{", "["), 1).when(bracket.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state.deepest, now).alias("deepest"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda state: state.deepest)


def _no_number(text: str):
    raise ValueError(f"{text} is no JSON")


#: Numbers stay as they are written; constants that JSON doesn't have are errors.
_DECODER = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=_no_number)


def _decoded(text: str):
    """The value of a JSON text; a ValueError if it is none or nests deeper than Python's reader goes."""
    try:
        return _DECODER.decode(text)
    except (ValueError, RecursionError) as error:
        raise ValueError(f"[MALFORMED_RECORD_IN_PARSING] a text is no JSON: {error}") from None


def _walk(value, keys: bool) -> Iterator[tuple[list[int], str | None, int]]:
    """(place, key or scalar, level) depth-first, in the order of the text; no recursion, so depth doesn't matter."""
    stack = [iter([((), None, value)])]
    while stack:
        for place, key, item in stack[-1]:
            inside = isinstance(item, (dict, list))
            if keys and key is not None:
                yield list(place), key, len(stack) - 1
            elif not keys and not inside:
                yield list(place), _as_text(item), len(stack) - 1
            if inside:
                named = item.items() if isinstance(item, dict) else ((None, v) for v in item)
                stack.append(iter([((*place, n), k, v) for n, (k, v) in enumerate(named)]))
                break
        else:
            stack.pop()


def _as_text(item) -> str | None:
    if isinstance(item, bool):
        return "true" if item else "false"
    return item


def _flattened(df: DataFrame, column: str, keep: list[str], name: str, depth: int | None, errors: str) -> DataFrame:
    """``(keep.., place, name)`` of the members of a JSON column, a batch of texts at a time."""
    if errors not in ("raise", "skip"):
        raise ValueError(f"errors must be raise or skip, not {errors}")
    text = unused(keep, "text")[0]
    given = df.select(*keep, F.col(column).alias(text))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("place", T.ArrayType(T.IntegerType())), T.StructField(name, T.StringType())])

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, found = [], [], []
            for row, body in enumerate(batch[text].to_pylist()):
                if body is None:
                    continue
                try:
                    value = _decoded(body)
                except ValueError:
                    if errors == "skip":
                        continue
                    raise
                for place, item, level in _walk(value, name == "key"):
                    if depth is not None and level > depth:
                        raise ValueError(f"JSON nests deeper than {depth}")
                    rows.append(row)
                    places.append(place)
                    found.append(item)
                    if len(rows) == _OUT_ROWS:
                        yield _taken(batch, rows, places, found)
                        rows, places, found = [], [], []
            if rows:
                yield _taken(batch, rows, places, found)

    def _taken(batch, rows, places, found) -> pa.RecordBatch:
        kept = [batch[i].take(pa.array(rows, pa.int32())) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(places, pa.list_(pa.int32())), pa.array(found, pa.string())], names=schema.names)

    return given.mapInArrow(flatten, schema)


#: Rows that a task hands on at once.
_OUT_ROWS = 20_000


def flatten_values(
    df: DataFrame, column: str, keep: list[str], depth: int | None = None, errors: str = "raise"
) -> DataFrame:
    """``(keep.., place, value)``: the scalars of a JSON column, as text, at any depth.

    ``place`` lists the member numbers on the way down, in the order of the
    text, so ordering by it is depth-first. Numbers are as written; of members
    of one name the last counts, in the place of the first. JSON that nests
    deeper than ``depth``, if given, is an error. A text that is not JSON is an
    error, or left out with ``errors="skip"``; NULL has no scalars.

    Members keep their order in the text only, which neither VARIANT nor a
    fixed schema holds, so texts are walked in Arrow batches: one scan, no
    join, and no depth has to be known.
    """
    return _flattened(df, column, keep, "value", depth, errors)


def flatten_keys(
    df: DataFrame, column: str, keep: list[str], depth: int | None = None, errors: str = "raise"
) -> DataFrame:
    """``(keep.., place, key)``: the object keys of a JSON column, at any depth; as ``flatten_values``."""
    return _flattened(df, column, keep, "key", depth, errors)
