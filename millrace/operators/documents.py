"""Frames packed into JSON documents, and documents unpacked into rows.

A packed document is ``{"data": {column: {"0": value, ..}}, "metadata":
{"dtypes": {column: dtype}, "object_type": ..}}``. A frame of more than
``chunk_rows`` rows is spread over several documents with running row keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import last_segment, unused
from millrace.functions.predicates import as_list
from millrace.functions.text import JSON_OPTIONS, to_json_text
from millrace.operators.dialects import spark_type
from millrace.operators.relation import project
from millrace.operators.reshape import CHUNK_ROWS, chunked_rows
from millrace.operators.schema import _is_type as is_type
from millrace.operators.schema import enforce

# The marker of a packed frame and the frame dtypes.
FRAME_TYPE = "<class 'pandas.core.frame.DataFrame'>"
FRAME_DTYPES = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
    "float": "float32", "double": "float64", "boolean": "bool", "string": "object",
    "timestamp": "datetime64[ns, UTC]", "timestamp_ntz": "datetime64[ns]",
}
DTYPE_SPARK = {name: spark for spark, name in FRAME_DTYPES.items()} | {
    "int": "bigint", "Int64": "bigint", "Float64": "double", "boolean": "boolean",
    "str": "string", "string": "string",
}


def frame_dtypes(schema: T.StructType, columns: list[str]) -> dict[str, str]:
    return {name: FRAME_DTYPES.get(schema[name].dataType.simpleString(), "object") for name in columns}


def pack_documents(
    df: DataFrame, by, order_by, columns: list[str] | None = None, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """``(by.., chunk, document)``: the rows of each group as packed documents, in the given order.

    A group of more than ``chunk_rows`` rows becomes several documents, with
    running row keys.
    """
    groups = as_list(by)
    names = columns or [c for c in df.columns if c not in groups]
    chunks = chunked_rows(df, groups, order_by, names, chunk_rows)
    position = unused(df, "_position")[0]

    def by_position(name: str):
        pairs = F.transform("rows", lambda row: F.struct(row[position].cast("string"), row[name]))
        return F.map_from_entries(pairs).alias(name)

    dtypes = [F.lit(dtype).alias(name) for name, dtype in frame_dtypes(df.schema, names).items()]
    metadata = F.struct(F.struct(*dtypes).alias("dtypes"), F.lit(FRAME_TYPE).alias("object_type"))
    body = F.struct(F.struct(*[by_position(n) for n in names]).alias("data"), metadata.alias("metadata"))
    return chunks.select(*groups, "chunk", to_json_text(body).alias("document"))


def stored_dtypes(df: DataFrame, document: str = "document") -> dict[str, str]:
    """The columns of all documents with their dtypes, in the documents' order.

    Where documents differ, numbers are float64 and all else is text; a column
    without a stored dtype is text. One row for each column comes back.
    """
    shape = "data MAP<STRING, STRING>, metadata STRUCT<dtypes: MAP<STRING, STRING>>"
    parsed = df.select(F.from_json(document, shape, JSON_OPTIONS).alias("d"))
    columns = parsed.select(F.posexplode(F.map_keys("d.data")).alias("place", "name"), F.col("d.metadata.dtypes").alias("dtypes"))
    found = columns.groupBy("name").agg(F.min("place").alias("place"), F.collect_set(F.coalesce(F.element_at("dtypes", F.col("name")), F.lit("object"))).alias("dtypes"))
    rows = sorted(found.collect(), key=lambda r: (r["place"], r["name"]))
    return {r["name"]: _common_dtype(r["dtypes"]) for r in rows}


def _common_dtype(dtypes: list[str]) -> str:
    if len(dtypes) == 1:
        return dtypes[0]
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return "float64" if all(DTYPE_SPARK.get(d, "string") in numbers for d in dtypes) else "object"


def _restored(value: Column, dtype: str, errors: str) -> Column:
    """A stored text as its dtype: whole numbers may end in .0, and times may be epoch milliseconds."""
    target = DTYPE_SPARK.get(dtype, "string")
    if target == "string":
        return value
    typed = value.try_cast(target)
    if target in ("tinyint", "smallint", "int", "bigint"):
        number = value.try_cast("double")
        typed = F.coalesce(typed, F.when(number == F.floor(number), number.try_cast(target)))
    if target.startswith("timestamp"):
        millis = F.timestamp_millis(value.try_cast("bigint"))
        typed = F.when(F.regexp_like(value, F.lit("^-?[0-9]{5,}$")), F.convert_timezone(F.current_timezone(), F.lit("UTC"), millis.cast("timestamp_ntz")) if target == "timestamp_ntz" else millis).otherwise(typed)
    if errors == "ignore":
        return typed
    wrong = F.concat(F.lit(f"a packed value is no {dtype}: "), value)
    return F.when(value.isNotNull() & typed.isNull(), F.raise_error(wrong).cast(target)).otherwise(typed)


def unpack_documents(
    df: DataFrame, document: str = "document", schema: dict | None = None,
    dtypes: dict | None = None, errors: str = "raise", position: str | None = None,
) -> DataFrame:
    """Packed documents as rows, columns typed by the stored dtypes; types in ``schema`` win over them.

    Without ``dtypes`` columns and dtypes are read from the documents, as
    ``stored_dtypes`` says; ``{"data": ..}`` alone will do. Values are read as
    text first, so that no value can make a document disappear. A document that
    is no JSON or has no ``data``, or a value that is not of its dtype, is an
    error; with ``errors="ignore"`` the first is one row without values and the
    second NULL. A document without rows, or NULL, gives none.
    """
    dtypes = stored_dtypes(df, document) if dtypes is None else dtypes
    names, schema = list(dtypes), schema or {}
    kept = [c for c in df.columns if c != document]
    shape = T.StructType([T.StructField("data", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))])
    d, bad, r, *cols = unused(kept, "_d", "_bad", "_r", *[f"_{i}" for i in range(len(names))])
    data = F.from_json(F.col(document), shape, JSON_OPTIONS).getField("data")
    parsed = df.select(*kept, data.alias(d), (F.col(document).isNotNull() & (data.isNull() | F.try_parse_json(document).isNull())).alias(bad))

    def entries(name: str):
        pairs = F.coalesce(F.map_entries(F.element_at(d, F.lit(name))), F.array().cast("array<struct<key:string,value:string>>"))
        return F.array_sort(F.transform(pairs, lambda e: F.struct(e.key.cast("bigint").alias("k"), e.value.alias("v"))))

    columns = parsed.select(*kept, bad, d, *[entries(n).alias(c) for c, n in zip(cols, names)])
    # A column that a document doesn't have is NULL in its rows; those that it has must agree.
    held = [F.map_contains_key(d, F.lit(n)) for n in names]
    keys = [F.col(c).getField("k") for c in cols]
    first = F.coalesce(*[F.when(h, k) for h, k in zip(held, keys)]) if names else F.array().cast("array<bigint>")
    agree = F.lit(True)
    for h, k in zip(held, keys):
        agree = agree & (~h | (k == first))
    zipped = F.arrays_zip(*cols) if names else F.array().cast("array<struct<>>")
    whole = F.when(F.coalesce(agree, F.lit(True)), zipped).otherwise(
        F.raise_error(F.lit("a packed document has columns with different row keys"))
    )
    nothing = F.array(F.struct(*[F.lit(None).cast("struct<k:bigint,v:string>").alias(c) for c in cols])) if names else zipped
    corrupt = F.raise_error(F.lit("a packed document is no JSON or has no data")) if errors == "raise" else nothing
    rows = columns.select(*kept, F.explode(F.when(F.col(bad), corrupt).otherwise(whole)).alias(r))
    place = [F.coalesce(*[F.col(r)[c]["k"] for c in cols]).alias(position)] if position else []
    own = {n for n, rule in schema.items() if is_type(rule)}
    texts = [F.col(r)[c]["v"] for c in cols]
    values = [text if n in own else _restored(text, dtypes[n], errors) for text, n in zip(texts, names)]
    frame = rows.select(*kept, *place, *[v.alias(n) for v, n in zip(values, names)])
    return enforce(frame, schema or None, errors=errors)


def cast_documents(df: DataFrame, key: str, overrides: dict[str, dict]) -> DataFrame:
    """Per-document column types: ``{document id: {column: type}}``.

    A value of such a document passes through the type and comes back in the
    column's own type, since one column has one type; ``one_document`` gives
    a single document with the types themselves.
    """
    changed = {}
    for doc_id, schema in overrides.items():
        for name, rule in schema.items():
            now = changed.get(name, F.col(name))
            through = F.col(name).cast(spark_type(rule)).cast(df.schema[name].dataType)
            changed[name] = F.when(F.col(key) == F.lit(doc_id), through).otherwise(now)
    return df.withColumns(changed) if changed else df


def variant_documents(df: DataFrame, key: str, overrides: dict[str, dict], columns: list[str] | None = None) -> DataFrame:
    """Per-document column types that stay: ``{document id: {column: type}}``.

    The columns (those of ``overrides`` if none are named) become VARIANT, and
    every value has its document's type in it, or else the column's own. A value
    that is not of its document's type is an error. As many branches are
    planned as there are types, however many documents have one.
    """
    names = columns or list(dict.fromkeys(c for types in overrides.values() for c in types))
    changed = {}
    for name in names:
        by_type: dict[str, list] = {}
        for doc_id, types in overrides.items():
            if name in types:
                by_type.setdefault(spark_type(types[name]).simpleString(), []).append(doc_id)
        value = F.col(name).cast("variant")
        for dtype, ids in by_type.items():
            value = F.when(F.col(key).isin(ids), F.col(name).cast(dtype).cast("variant")).otherwise(value)
        changed[name] = value
    return df.withColumns(changed) if changed else df


def variant_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """The types of VARIANT columns' values in DDL, as columns ``<name>_type``; NULL for NULL."""
    return df.withColumns({f"{name}_type": F.schema_of_variant(name) for name in columns})


def one_document(df: DataFrame, key: str, doc_id, schema: dict | None = None) -> DataFrame:
    """The rows of one document, with a schema of its own."""
    return enforce(df.where(F.col(key) == F.lit(doc_id)), schema)


def collection(df: DataFrame, path: str, name: str) -> DataFrame:
    """The documents directly under collection ``name``, keyed by their last path segment."""
    prefix = name.strip("/") + "/"
    rest = F.substr(path, F.lit(len(prefix) + 1))
    members = df.where(F.col(path).startswith(prefix) & ~rest.contains("/"))
    kept = [c for c in df.columns if c != path]
    return members.select(last_segment(F.col(path)).alias("doc_id"), *kept)


def write_documents(df: DataFrame, target: str, by, order_by, columns: list[str] | None = None, mode: str = "errorifexists", chunk_rows: int = CHUNK_ROWS) -> None:
    """Packed documents as JSON lines, restricted to ``columns`` when given.

    A group of more than ``chunk_rows`` rows becomes several documents.
    """
    groups = as_list(by)
    order = [item.partition(" ")[0].lstrip("-") for item in as_list(order_by)]
    frame = project(df, list(dict.fromkeys([*groups, *order, *columns]))) if columns else df
    pack_documents(frame, groups, order_by, columns, chunk_rows).write.mode(mode).json(target)
