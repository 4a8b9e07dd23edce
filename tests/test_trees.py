import random

import pytest
from conftest import rows
from millrace.operators import lookup
from millrace.sources import files


def test_roots_and_depths_of_any_tree(spark):
    random.seed(2)
    parents = {n: (None if n < 3 else random.choice([n - 1, n - 1, random.randrange(n)])) for n in range(300)}
    parents[300] = 999  # a parent that isn't there

    def top(n, depth=0):
        return (n, depth) if parents[n] is None or parents[n] not in parents else top(parents[n], depth + 1)

    frame = spark.createDataFrame([(n, p, "x", "y") for n, p in parents.items()], "child long, parent long, root string, up string")
    got = lookup.tree_roots(frame, "child", "parent")
    assert got.columns == ["child", "parent", "up", "root", "depth"]
    assert rows(got.select("child", "root", "depth")) == sorted([(n, *top(n)) for n in parents], key=repr)
    assert max(d for _, _, d in rows(got.select("child", "root", "depth"))) > 20


def test_cycles_double_children_and_nulls(spark):
    with pytest.raises(ValueError, match="cycle"):
        lookup.tree_roots(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None)], "c long, p long"), "c", "p")
    with pytest.raises(ValueError, match="several rows"):
        lookup.tree_roots(spark.createDataFrame([(1, 2), (1, 3)], "c long, p long"), "c", "p")
    got = lookup.tree_roots(spark.createDataFrame([(None, 1), (1, None), (2, 1)], "c long, p long"), "c", "p")
    assert rows(got) == [(1, None, 1, 0), (2, 1, 1, 1), (None, 1, None, 0)]
    assert lookup.tree_roots(spark.createDataFrame([], "c long, p long"), "c", "p").count() == 0


def test_walk_and_glob(spark):
    paths = ["a/x.txt", "a/b/y.txt", "a/b/c/z.csv", "top.txt", "a.b/x+y.txt"]
    inventory = spark.createDataFrame([(f"file:/data/{p}", len(p), None) for p in paths], "path string, length long, modificationTime timestamp")
    walked = files.walk_folders(inventory, "/data/")
    found = {r["path"]: (r["is_dir"], r["depth"], r["num_files"], r["num_bytes"]) for r in walked.collect()}
    assert found[""] == (True, 0, 5, sum(map(len, paths))) and found["a"] == (True, 1, 3, 7 + 9 + 11) and found["a/b/c/z.csv"] == (False, 4, 1, 11)
    assert len(found) == 5 + 5
    match = lambda pattern: [r["path"] for r in files.glob_paths(walked.where("NOT is_dir"), pattern).orderBy("path").collect()]
    assert match("*.txt") == ["top.txt"] and match("**/*.txt") == ["a.b/x+y.txt", "a/b/y.txt", "a/x.txt", "top.txt"]
    assert match("a/**") == ["a/b/c/z.csv", "a/b/y.txt", "a/x.txt"] and match("a/?.txt") == ["a/x.txt"]
    assert match("a.b/x+[xyz].txt") == ["a.b/x+y.txt"] and match("a/[!y].txt") == ["a/x.txt"] and match("a.b/x+[!y].txt") == []
