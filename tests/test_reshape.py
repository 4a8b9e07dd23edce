import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import documents as D
from millrace.operators import numbering, reshape as R


def test_columns_to_rows_and_back(spark):
    df = spark.createDataFrame([("k", [1, 2, 3], [4, 5, 6], [7, 8, None])], "key string, a array<int>, b array<int>, c array<int>")
    records = R.columns_to_rows(df, ["a", "b", "c"], position="i")
    assert rows(records) == [("k", 0, 1, 4, 7), ("k", 1, 2, 5, 8), ("k", 2, 3, 6, None)]
    back = R.rows_to_columns(records, "key", "i", ["a", "b", "c"])
    assert back.first().asDict() == {"key": "k", "chunk": 0, "a": [1, 2, 3], "b": [4, 5, 6], "c": [7, 8, None]}


def test_unequal_arrays_raise(spark):
    df = spark.createDataFrame([([1, 2], [4])], "a array<int>, b array<int>")
    with pytest.raises(Exception, match="unequal length"):
        R.columns_to_rows(df, ["a", "b"]).collect()


def test_row_numbers_match_a_window_on_skewed_groups(spark):
    # One group holds most rows, one key is NULL.
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, F.col("id").cast("string")).alias("g"),
        F.xxhash64("id").alias("o"), "id",
    )
    got = {r["id"]: r["n"] for r in numbering.number_rows(df, "g", ["-o"], "n").collect()}
    want = df.selectExpr("id", "row_number() over (partition by g order by o desc) as n")
    assert got == {r["id"]: r["n"] for r in want.collect()}


def test_row_numbers_of_one_group_use_many_tasks(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("g"), "id", F.repeat(F.lit("x"), F.lit(100)).alias("pad"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(df, "g", "id", "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(numbered.inputFiles()) > 4
    assert numbered.where(F.col("n") != F.col("id") + 1).count() == 0


def test_chunks_are_bounded_whole_and_ordered(spark):
    df = spark.range(2500).select(F.lit("hot").alias("g"), "id")
    chunks = R.rows_to_columns(df, "g", "-id", ["id"], chunk_rows=400)
    found = {r["chunk"]: r["id"] for r in chunks.collect()}
    assert [len(found[i]) for i in range(7)] == [400] * 6 + [100]
    assert sum((found[i] for i in range(7)), []) == list(range(2499, -1, -1))


def test_chunks_of_columns_without_an_order(spark):
    df = spark.range(20).select(F.lit("g").alias("g"), "id", F.create_map(F.lit("k"), F.col("id")).alias("m"))
    found = R.rows_to_columns(df, "g", "-id", ["id", "m"], chunk_rows=8).orderBy("chunk").collect()
    assert [r["id"] for r in found] == [list(range(19, 11, -1)), list(range(11, 3, -1)), [3, 2, 1, 0]]
    assert [m["k"] for r in found for m in r["m"]] == list(range(19, -1, -1))


def test_row_numbers_over_several_columns_and_over_all_rows(spark):
    df = spark.range(500).selectExpr("id % 3 as a", "id % 2 as b", "id")
    got = numbering.number_rows(df, ["a", "b"], "id", "n")
    want = df.selectExpr("*", "row_number() over (partition by a, b order by id) as n")
    assert rows(got) == rows(want)
    whole = numbering.number_rows(df.select("id"), [], "id", "n", 0)
    assert whole.count() == 500 and whole.where("id != n").isEmpty()
    assert numbering.number_rows(df.where("id < 0"), "a", "id").isEmpty()


@pytest.fixture
def nested(spark):
    texts = [
        (1, '{"a":1,"b":{"c":2},"d":[3,{"e":4}]}'),
        (2, '{"a": 1, "b": [1, [2, [3, 4]]]}'),
        (3, '{"s": "a [b] {c} \\"q\\" \\\\", "n": null, "t": true, "x": {}, "y": []}'),
        (4, "7"),
        (6, '["[]", "{}", [], {"k": []}, ""]'),
        (7, '[[[['),
        (5, None),
    ]
    return spark.createDataFrame(texts, "id int, j string")


def test_flattened_values_are_depth_first(nested):
    found = {}
    for row in R.flatten_values(nested, "j", ["id"], errors="skip").orderBy("id", "place").collect():
        found.setdefault(row["id"], []).append(row["value"])
    assert found[1] == ["1", "2", "3", "4"]
    assert found[2] == ["1", "1", "2", "3", "4"]
    assert found[3] == ['a [b] {c} "q" \\', None, "true"]  # members come as in the text
    assert found[4] == ["7"]
    assert found[6] == ["[]", "{}", ""]
    assert 5 not in found and 7 not in found


def test_texts_that_are_not_json_raise(nested):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        R.flatten_values(nested, "j", ["id"]).collect()


def test_flattened_keys(nested):
    found = {}
    for row in R.flatten_keys(nested, "j", ["id"], errors="skip").orderBy("id", "place").collect():
        found.setdefault(row["id"], []).append(row["key"])
    assert found == {1: ["a", "b", "c", "d", "e"], 2: ["a", "b"], 3: ["s", "n", "t", "x", "y"], 6: ["k"]}


def test_depth_ignores_brackets_in_texts(nested):
    found = {r["id"]: r["d"] for r in nested.select("id", R.json_depth(F.col("j")).alias("d")).collect()}
    assert found == {1: 3, 2: 4, 3: 2, 4: 0, 5: None, 6: 3, 7: 4}


def test_maps_turn_round(spark):
    df = spark.sql("select map('a', 1, 'b', 2, 'c', 3, 'd', 1) as m")
    assert df.select(R.invert_map(F.col("m")).alias("m")).first()["m"] == {1: "d", 2: "b", 3: "c"}
    pairs = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("c", 2, 5)], "k string, v int, o int")
    assert rows(R.invert_pairs(pairs, "k", "v", "o")) == [(1, "b"), (2, "c")]


def test_scalars_are_wrapped(spark):
    df = spark.sql("select 1 as a, array(1, 2) as b")
    assert rows(R.wrap_scalars(df, ["a", "b"])) == [([1], [1, 2])]


@pytest.fixture
def frames(spark):
    data = [(f"doc{d}", a, b, c) for d in range(3) for a, b, c in [(1, "a", 1), (2, "b", 2), (3, "c", None)]]
    return spark.createDataFrame(data, "doc_id string, a bigint, b string, c bigint")


def test_packed_document_has_the_frame_layout(frames):
    packed = D.pack_documents(frames, "doc_id", "a")
    document = json.loads(packed.where("doc_id = 'doc1'").first()["document"])
    assert document == {
        "data": {
            "a": {"0": 1, "1": 2, "2": 3}, "b": {"0": "a", "1": "b", "2": "c"}, "c": {"0": 1, "1": 2, "2": None},
        },
        "metadata": {
            "dtypes": {"a": "int64", "b": "object", "c": "int64"},
            "object_type": "<class 'pandas.core.frame.DataFrame'>",
        },
    }


@pytest.mark.parametrize("chunk_rows", [1, 2, 1000])
def test_pack_and_unpack_round_trip(frames, chunk_rows):
    packed = D.pack_documents(frames, "doc_id", "a", chunk_rows=chunk_rows)
    back = D.unpack_documents(packed)
    assert back.drop("chunk").dtypes == frames.dtypes
    assert rows(back.drop("chunk")) == rows(frames)


def test_unpack_schema_overrides_stored_dtypes(frames):
    packed = D.pack_documents(frames, "doc_id", "a").drop("chunk")
    back = D.unpack_documents(packed, schema={"a": str, "c": float}, position="i")
    assert back.dtypes == [("doc_id", "string"), ("i", "bigint"), ("a", "string"), ("b", "string"), ("c", "double")]


def test_documents_of_different_dtypes(spark, frames):
    packed = D.pack_documents(frames, "doc_id", "a").drop("chunk")
    other = D.pack_documents(frames.withColumn("a", F.col("a") + 0.5), "doc_id", "a").drop("chunk")
    both = packed.unionByName(other)
    assert dict(D.unpack_documents(both).dtypes)["a"] == "double" and D.unpack_documents(both).count() == 18
    assert D.unpack_documents(both, dtypes={"a": "float64", "b": "object"}).count() == 18


def test_no_document_is_lost(spark):
    dtypes = '"metadata": {"dtypes": {"a": "int64", "t": "datetime64[ns]"}}'
    texts = [
        '{"data": {"a": {"0": 1, "1": 2.0}, "t": {"0": 1704067200000, "1": "2024-01-02 00:00:00"}}, %s}' % dtypes,
        '{"data": {"a": {"0": 1.5}}, %s}' % dtypes,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, document string")
    first = D.unpack_documents(df.where("i = 0"), position="at")
    assert [(r["at"], r["a"], str(r["t"])) for r in first.orderBy("at").collect()] == [(0, 1, "2024-01-01 00:00:00"), (1, 2, "2024-01-02 00:00:00")]
    with pytest.raises(Exception, match="no int64: 1.5"):
        D.unpack_documents(df).collect()
    assert rows(D.unpack_documents(df, schema={"a": float}).select("i", "a")) == [(0, 1.0), (0, 2.0), (1, 1.5)]
    assert rows(D.unpack_documents(df, errors="ignore").select("i", "a")) == [(0, 1), (0, 2), (1, None)]
    cut = df.union(spark.createDataFrame([(2, texts[0][:-40])], "i int, document string"))
    with pytest.raises(Exception, match="no JSON"):
        D.unpack_documents(cut, schema={"a": float}).collect()
    assert rows(D.unpack_documents(cut, schema={"a": float}, errors="ignore").select("i"))[-1] == (2,)
    bare = spark.createDataFrame([('{"data": {"b": {"0": "x"}, "a": {"0": 3}}}',)], "document string")
    assert D.unpack_documents(bare, schema={"a": int}).collect()[0].asDict() == {"b": "x", "a": 3}


def test_too_small_a_depth_is_an_error(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": {"d": 2}}}')], "id int, j string")
    for function in (R.flatten_values, R.flatten_keys):
        assert function(df, "j", ["id"], depth=3).count() == function(df, "j", ["id"]).count()
        with pytest.raises(Exception, match="deeper than 1"):
            function(df, "j", ["id"], depth=1).collect()


def test_null_values_of_a_map_are_left_out(spark):
    assert spark.sql("SELECT map('a', 1, 'b', NULL) AS m").select(R.invert_map(F.col("m")).alias("m")).first()["m"] == {1: "a"}


def test_document_schemas(spark):
    df = spark.createDataFrame([("x", "7"), ("y", "7.5")], "doc_id string, v string")
    assert rows(D.cast_documents(df, "doc_id", {"x": {"v": float}})) == [("x", "7.0"), ("y", "7.5")]
    assert D.one_document(df, "doc_id", "x", {"v": int}).dtypes == [("doc_id", "string"), ("v", "bigint")]


def test_collections_hold_their_own_documents_only(spark):
    df = spark.createDataFrame([("c/a", 1), ("c/b", 2), ("c/a/sub/z", 3), ("cc/a", 4)], "path string, v int")
    assert rows(D.collection(df, "path", "c")) == [("a", 1), ("b", 2)]
    assert rows(D.collection(df, "path", "c/a/sub")) == [("z", 3)]
