"""Resource names, paths and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shorten(name: Column, drop: int = 0) -> Column:
    """``a/A/b/B/c/C`` to ``A/B/C``, leaving out the first ``drop`` ids."""
    ids = F.filter(F.split(name, "/"), lambda _, i: i % 2 == 1)
    kept = F.filter(ids, lambda _, i: i >= drop) if drop else ids
    return F.array_join(kept, "/")


def last_segment(path: Column) -> Column:
    """The text after the last slash."""
    return F.substring_index(path, "/", -1)


def table_id_parts(table_id: Column) -> Column:
    """``[[project.]dataset.]table`` as a struct; missing parts are NULL, more than three give NULL."""
    parts = F.split(table_id, r"\.")
    fields = F.struct(
        F.try_element_at(parts, F.lit(-3)).alias("project"),
        F.try_element_at(parts, F.lit(-2)).alias("dataset"),
        F.try_element_at(parts, F.lit(-1)).alias("table"),
    )
    return F.when(F.size(parts) <= 3, fields)


def url_decode(text: Column) -> Column:
    """Percent escapes decoded; a plus sign stays a plus sign, as in a path."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def partition_values(path: Column) -> Column:
    """The ``key=value`` segments of a path as a map, values URL-decoded."""
    pairs = F.filter(F.split(path, "/"), lambda part: part.contains("="))
    return F.map_from_entries(
        F.transform(
            pairs,
            lambda part: F.struct(
                F.substring_index(part, "=", 1),
                url_decode(F.substring(part, F.instr(part, "=") + 1, F.length(part))),
            ),
        )
    )


def as_array(column: Column, dtype: T.DataType) -> Column:
    """The column itself when it is an array, else a one-element array of it."""
    return column if isinstance(dtype, T.ArrayType) else F.array(column)


def unused(taken, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``taken`` (a frame or names) is called so."""
    held = {c.lower() for c in getattr(taken, "columns", taken)}
    found = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        found.append(name)
    return found
