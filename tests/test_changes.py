import json
import os

import pytest
from conftest import rows
from millrace.sources import changes, files, folder, sinks, snapshots, tables
from millrace.sources.layout import RangePartition
from pyspark.sql import functions as F


@pytest.fixture
def orders(spark, database):
    """(name, place) of a table of eight files, keys in order."""
    frame = spark.range(80).select(F.col("id").alias("k"), (F.col("id") % 10).alias("v"), F.concat(F.lit("n"), "id").alias("name"))
    name = f"{database}.orders"
    frame.repartitionByRange(8, "k").write.saveAsTable(name)
    return name, changes.table_location(spark, name).removeprefix("file:")


def names(folder):
    return {os.path.relpath(os.path.join(at, f), folder) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet") and not os.path.relpath(at, folder).startswith("_")}


def test_delete_rewrites_touched_files_only(spark, orders):
    name, place = orders
    before = names(place)
    done = changes.delete_rows(spark, name, [("k", ">=", 15), ("k", "<", 25)])
    assert (done.rows, done.inserted) == (10, 0) and done.files == len(before - names(place)) < 4
    assert rows(spark.table(name).select("k")) == sorted([(k,) for k in range(80) if not 15 <= k < 25], key=repr)
    untouched = before & names(place)
    assert len(untouched) == len(before) - done.files
    assert changes.delete_rows(spark, name, condition="k = 1000") == changes.Change(0, 0, 0)
    changes.delete_rows(spark, name, condition="k < 80")
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError):
        changes.delete_rows(spark, name)


def test_update_uses_old_values_and_leaves_nulls(spark, orders):
    name, place = orders
    changes.update_rows(spark, name, {"name": None}, condition="k = 3")
    before = names(place)
    done = changes.update_rows(spark, name, {"v": F.col("v") + F.col("k"), "NAME": "x"}, condition="name LIKE 'n7%'")
    assert done.rows == 11
    want = [(k, k % 10 + k if str(k)[0] == "7" else k % 10, "x" if str(k)[0] == "7" else None if k == 3 else f"n{k}") for k in range(80)]
    assert rows(spark.table(name)) == sorted(want, key=repr)
    assert len(before & names(place)) >= 5
    with pytest.raises(ValueError):
        changes.update_rows(spark, name, {"no": 1})


def test_merge(spark, orders):
    name, place = orders
    before = names(place)
    source = spark.createDataFrame([(5, "five"), (6, None), (200, "new"), (None, "none")], "k long, name string")
    done = changes.merge_rows(source, name, "k")
    assert (done.rows, done.inserted, done.files) == (2, 2, 1) and len(before & names(place)) == 7
    got = {r["k"]: (r["v"], r["name"]) for r in spark.table(name).collect()}
    assert got[5] == (5, "five") and got[6] == (6, None) and got[200] == (None, "new") and got[None] == (None, "none") and len(got) == 82
    changes.merge_rows(source, name, "k", matched={"v": F.col("target.v") * 100 + F.length("source.name")}, unmatched="skip")
    got = {r["k"]: r["v"] for r in spark.table(name).collect()}
    assert got[5] == 504 and got[6] is None and got[200] is None and len(got) == 82
    assert changes.merge_rows(source, name, "k", matched="delete", unmatched="skip").rows == 3
    assert changes.merge_rows(source, name, "k", matched="keep").inserted == 4
    with pytest.raises(ValueError, match="several rows"):
        changes.merge_rows(source.union(source), name, "k")
    with pytest.raises(ValueError, match="no column"):
        changes.merge_rows(source.withColumn("w", F.lit(1)), name, "k")


def test_partitions_follow_the_values(spark, database):
    name = f"{database}.parts"
    frame = spark.createDataFrame([(k, f"p/{k % 3}", "a b") for k in range(30)], "k long, part string, other string")
    tables.write_table(frame, name, partition_by=["part", "other"])
    place = changes.table_location(spark, name).removeprefix("file:")
    before = names(place)
    changes.update_rows(spark, name, {"part": "q=1"}, condition="k < 3 AND part = 'p/1'")
    changes.delete_rows(spark, name, {"part": "p/2"})
    want = [(k, "q=1" if k == 1 else f"p/{k % 3}", "a b") for k in range(30) if k % 3 != 2]
    assert rows(spark.table(name).select("k", "part", "other")) == sorted(want, key=repr)
    assert rows(tables.table_partitions(spark, name).filter("part LIKE 'q%'")) == [("q=1", "a b")]
    assert before & names(place)


def test_derived_partitions_follow_the_source_column(spark, database):
    name = f"{database}.ranged"
    tables.write_table(spark.range(100).withColumn("v", F.lit(0)), name, range_partition=RangePartition("id", 0, 100, 10))
    changes.update_rows(spark, name, {"id": F.col("id") + 50, "v": 1}, [("id", "<", 10)])
    got = tables.read_table(spark, name, filters=[("id", ">=", 50), ("id", "<", 60)])
    assert got.columns == ["id", "v"] and got.count() == 20 and got.filter("v = 1").count() == 10
    changes.merge_rows(spark.createDataFrame([(55, 7), (3, 3)], "id long, v int"), name, "id", matched={"v": F.col("source.v")})
    assert rows(tables.read_table(spark, name, filters=[("id", "=", 3)])) == [(3, 3)]


def test_swap_that_was_cut_off_is_finished(spark, orders, monkeypatch):
    name, _ = orders
    moved = folder.Folder.move

    def failing(self, source, target):
        if source.startswith(changes.STAGED):
            raise OSError("lost")
        moved(self, source, target)

    monkeypatch.setattr(folder.Folder, "move", failing)
    with pytest.raises(OSError):
        changes.delete_rows(spark, name, condition="k = 7")
    monkeypatch.undo()
    assert changes.recover(spark, name) == 1 and changes.recover(spark, name) == 0
    assert rows(spark.table(name).select("k")) == sorted([(k,) for k in range(80) if k != 7], key=repr)


def test_change_by_someone_else_is_noticed(spark, orders):
    name, _ = orders
    files = changes._Files(spark, name)
    touched = files.touched(files.placed().where("k = 7"))
    changes.delete_rows(spark, name, condition="k = 8")
    with pytest.raises(Exception, match="changed by someone else|PATH_NOT_FOUND"):
        files.swap(touched, lambda df: df.where("k <> 7")) if files.fs.exists(next(iter(touched))) else files.fs.expect(next(iter(touched)), 1)


def test_snapshots_outlive_changes(spark, orders):
    name, place = orders
    first = rows(spark.table(name))
    assert snapshots.take_snapshot(spark, name, "first") == 8
    changes.delete_rows(spark, name, condition="k < 20")
    changes.update_rows(spark, name, {"v": 0}, condition="k BETWEEN 30 AND 35")
    second = rows(spark.table(name))
    snapshots.take_snapshot(spark, name, "second")
    tables.add_columns(spark, name, {"more": "str"})
    changes.update_rows(spark, name, {"more": "m"})
    assert rows(snapshots.read_snapshot(spark, name, "first")) == first
    assert rows(snapshots.read_snapshot(spark, name, "second")) == second
    assert rows(snapshots.read_snapshot(spark, name, "first", ["k"], [("k", "<", 2)])) == [(0,), (1,)]
    assert {r["name"]: r["num_files"] for r in snapshots.list_snapshots(spark, name).collect()}["first"] == 8
    with pytest.raises(ValueError, match="has a snapshot"):
        snapshots.take_snapshot(spark, name, "first")
    snapshots.drop_snapshot(spark, name, "second")
    assert snapshots.vacuum(spark, name) > 0 and snapshots.vacuum(spark, name) == 0
    assert rows(snapshots.read_snapshot(spark, name, "first")) == first
    snapshots.restore_snapshot(spark, name, "first")
    assert rows(spark.table(name).select("k", "v", "name")) == first
    assert rows(snapshots.read_snapshot(spark, name, "first")) == first
    with pytest.raises(ValueError, match="no snapshot"):
        snapshots.read_snapshot(spark, name, "none")


def test_snapshots_of_partitioned_and_empty_tables(spark, database):
    name = f"{database}.parts"
    tables.write_table(spark.createDataFrame([(k, f"p/{k % 3}") for k in range(9)], "k long, part string"), name, partition_by="part")
    first = rows(spark.table(name))
    snapshots.take_snapshot(spark, name, "s")
    changes.delete_rows(spark, name, {"part": "p/1"})
    tables.insert(spark.createDataFrame([(100, "new")], "k long, part string"), name)
    assert rows(snapshots.read_snapshot(spark, name, "s")) == first
    tables.create_table(spark, f"{database}.none", {"a": int})
    snapshots.take_snapshot(spark, f"{database}.none", "s")
    tables.insert(spark.createDataFrame([(1,)], "a long"), f"{database}.none")
    assert snapshots.read_snapshot(spark, f"{database}.none", "s").count() == 0


def test_copies_carry_properties_and_clustering(spark, database):
    name, copy = f"{database}.made", f"{database}.copy"
    tables.write_table(spark.range(50).withColumn("v", F.col("id") % 7), name, cluster_by=["v"])
    tables.set_properties(spark, name, {"team": "it's \\ us", "millrace.note": "n"})
    tables.copy_table(spark, name, copy)
    found = tables.table_properties(spark, copy)
    assert found["team"] == "it's \\ us" and found["millrace.note"] == "n" and json.loads(found[tables.CLUSTER_PROPERTY]) == ["v"]


def test_files_get_names(spark, scratch):
    frame = spark.createDataFrame([(k, k % 3, f"p/{k % 2}") for k in range(30)], "v long, a long, b string").repartition(5)
    path = scratch("named.parquet")
    sinks.write_parquet(frame, path, partition_by=["a", "b"], basename="{i}.parquet")
    local = path.removeprefix("file:")
    assert {"a=1/b=p%2F0/0.parquet", "a=2/b=p%2F1/0.parquet"} <= names(local) and all(n.rpartition("/")[2][0].isdigit() for n in names(local))
    assert rows(files.read_parquet(spark, path).select("v", "a", "b")) == rows(frame)
    assert sinks.name_files(spark, path, "{i}.parquet") == 0
    plain = scratch("plain.parquet")
    sinks.write_parquet(frame, plain, basename="part-{i:03}.parquet")
    assert names(plain.removeprefix("file:")) == {f"part-{i:03}.parquet" for i in range(5)}
    with pytest.raises(ValueError):
        sinks.write_parquet(frame, scratch("x.parquet"), basename="same.parquet")
