import math
import random

import numpy as np
import pytest
from cases import plan, rows
from millrace.llm import topk
from pyspark.sql import functions as F


def brute(data, asks, k):
    usable = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, qv in {(i, tuple(v)) for i, v in usable if asks(i)}:
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q)[:k]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(found, key=repr)


def ask(spark, data, k=5, **options):
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    frame = frame.select("vec_id", topk.whole_vectors(frame).alias("vec"))
    return rows(topk.top_k(frame, F.col("vec_id") % 4 == 0, k, **options))


@pytest.mark.parametrize("kind", ["spread", "copies", "few", "small", "odd", "empty", "large"])
def test_equals_brute_force(spark, kind, monkeypatch):
    random.seed(7)
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    data = [(i, [random.gauss(0, 0.3) for _ in range(7)]) for i in range({"spread": 150, "copies": 60, "small": 4}.get(kind, 30))]
    if kind == "copies":
        data += [(100 + i, data[3][1]) for i in range(80)] + [(200 + i, [0.0] * 7) for i in range(20)]
    if kind == "few":
        data = [(i, [float(i % 2), -1.0]) for i in range(12)]
    if kind == "odd":
        data += [(40, None), (44, [1.0, None]), (48, [float("nan")]), (52, [float("inf"), 1.0]), (None, [1.0]), (60, []), (64, [0.5]), (68, [0.5])]
    if kind == "empty":
        data = []
    if kind == "large":
        data = [(i, [x * 1e6 for x in v]) for i, v in data]
    data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]
    assert ask(spark, data) == brute(data, lambda i: i % 4 == 0, 5)


def test_more_nodes_than_dimensions_and_an_id_with_two_vectors(spark, monkeypatch):
    random.seed(8)
    monkeypatch.setattr(topk, "BLOCK", 10)
    data = [(i, [float(random.randint(-3, 3)), float(random.randint(-3, 3))]) for i in range(40)] + [(5, [2.5, 1.0]), (6, [-2.5, 1.0])]
    for nodes in (1, 3):
        assert ask(spark, data, 6, nodes=nodes) == brute(data, lambda i: i % 4 == 0, 6)


def test_nodes_read_their_dimensions_alone(spark):
    members = spark.createDataFrame([(n, n, [n, 10 * n, 100 * n]) for n in range(1, 4)], "first long, id long, vec array<long>")
    blocks, n = topk._blocks(members, 10, "blocks", topk._slices(3, 2))
    assert n == 1 and rows(blocks.select("node", "ids", "vectors")) == [(0, [1, 2, 3], [1, 2, 3]), (1, [1, 2, 3], [10, 100, 20, 200, 30, 300])]


def test_nothing_that_grows_with_the_table_is_broadcast(spark, monkeypatch):
    random.seed(9)
    monkeypatch.setattr(topk, "BLOCK", 20)
    data = [(i, [float(random.randint(-9, 9)) for _ in range(4)]) for i in range(100)]
    frames, write = [], topk.materialise

    def watched(df, label="rows", **options):
        frames.append(df)
        return write(df, label, **options)

    monkeypatch.setattr(topk, "materialise", watched)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    frame = frame.select("vec_id", topk.whole_vectors(frame).alias("vec"))
    frames.append(topk.top_k(frame, F.col("vec_id") % 4 == 0, 5))
    # These tables are far below the session's bound, so without a word Spark would broadcast them through the driver.
    assert not any("Broadcast" in plan(df) for df in frames)
    # Lists of parts, whose number grows with the pairs, are read once and not written.
    assert not any("parts" in df.columns for df in frames)
    assert rows(frames[-1]) == brute(data, lambda i: i % 4 == 0, 5)


@pytest.mark.parametrize("top", [9, 10_000, 1 << 28])
def test_scores_are_exact_in_every_kind_of_number(top, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 12)
    rng = np.random.default_rng(3)
    q, v = rng.integers(-top, top + 1, (7, 5)), rng.integers(-top, top + 1, (6, 5))
    pieces = list(topk.scores(q, v))
    assert [n for n, _ in pieces] == [0, 2, 4, 6]
    assert np.array_equal(np.concatenate([x.astype(np.int64) for _, x in pieces]), q @ v.T)
