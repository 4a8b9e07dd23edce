"""Random inputs against plain Python."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.functions.predicates import where, where_file
from millrace.operators import documents, lookup, numbering, reshape

settings.register_profile(
    "spark", max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
settings.load_profile("spark")

small = st.one_of(st.none(), st.integers(-3, 3))
records = st.lists(st.tuples(small, small), min_size=1, max_size=12)
filters = st.lists(
    st.one_of(
        st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["=", ">", "<", ">=", "<="]), st.integers(-3, 3)),
        st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["IN", "in"]), st.lists(st.integers(-3, 3), max_size=3)),
        st.dictionaries(st.sampled_from(["a", "b"]), st.one_of(st.integers(-3, 3), st.lists(st.integers(-3, 3), max_size=3)), min_size=1),
    ),
    max_size=4,
)
PYTHON = {
    "=": lambda x, y: x == y, ">": lambda x, y: x > y, "<": lambda x, y: x < y,
    ">=": lambda x, y: x >= y, "<=": lambda x, y: x <= y, "IN": lambda x, y: x in y,
}


def passes(row, item):
    if isinstance(item, dict):
        return all(passes(row, (k, "IN", v if isinstance(v, list) else [v])) for k, v in item.items())
    name, op, value = item
    found = row["ab".index(name)]
    return found is not None and PYTHON[op.upper()](found, value)


def frame(spark, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], "i int, a int, b int")


def ids(df):
    return sorted(row["i"] for row in df.collect())


@given(data=records, items=filters)
def test_filters(spark, data, items):
    want = [i for i, row in enumerate(data) if all(passes(row, item) for item in items)]
    assert ids(where(frame(spark, data), items)) == want


@given(data=records, groups=st.lists(filters.filter(bool), min_size=1, max_size=3))
def test_or_of_ands(spark, data, groups):
    want = [i for i, row in enumerate(data) if any(all(passes(row, item) for item in group) for group in groups)]
    assert ids(where_file(frame(spark, data), groups)) == want


def leaves(value):
    """Scalars depth-first, members of an object by key."""
    if isinstance(value, dict):
        return [x for key in value for x in leaves(value[key])]
    if isinstance(value, list):
        return [x for item in value for x in leaves(item)]
    return [value]


def keys(value):
    if isinstance(value, dict):
        return [x for key in value for x in [key, *keys(value[key])]]
    if isinstance(value, list):
        return [x for item in value for x in keys(item)]
    return []


json_values = st.recursive(
    st.one_of(st.none(), st.integers(-9, 9), st.text(alphabet='ab{}[]"\\\\,:', max_size=5)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.sampled_from(["k", "l", "[", "a\\"]), inner, max_size=3)),
    max_leaves=8,
)


@given(values=st.lists(json_values, min_size=1, max_size=6))
def test_flattening(spark, values):
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    got_values = {i: [] for i in range(len(values))}
    for row in reshape.flatten_values(df, "j", ["i"]).orderBy("i", "place").collect():
        got_values[row["i"]].append(row["value"])
    as_text = lambda x: x if x is None or isinstance(x, str) else str(x)
    assert got_values == {i: [as_text(x) for x in leaves(v)] for i, v in enumerate(values)}
    got_keys = {i: [] for i in range(len(values))}
    for row in reshape.flatten_keys(df, "j", ["i"]).orderBy("i", "place").collect():
        got_keys[row["i"]].append(row["key"])
    assert got_keys == {i: keys(v) for i, v in enumerate(values)}


@given(groups=st.lists(small, min_size=1, max_size=40))
def test_numbers_and_round_trip(spark, groups):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "i int, g int")
    got = {row["i"]: row["n"] for row in numbering.number_rows(df, "g", "-i", "n").collect()}
    assert got == {i: sum(1 for j, h in enumerate(groups) if h == g and j >= i) for i, g in enumerate(groups)}
    packed = documents.pack_documents(df, "g", "i", chunk_rows=3)
    back = documents.unpack_documents(packed, dtypes={"i": "int32"})
    assert sorted(map(repr, back.select("i", "g").collect())) == sorted(map(repr, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@given(left=st.lists(small, min_size=1, max_size=20), right=st.lists(small, max_size=8))
@settings(max_examples=4)
def test_salted_joins(spark, how, left, right):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, i int")
    b = spark.createDataFrame([(k, j) for j, k in enumerate(right)], "k bigint, j int")
    salted = lookup.salted_join(a, b, "k", how, min_rows=2, n_hot=2, salts=3)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, a.join(b, "k", how).collect()))
