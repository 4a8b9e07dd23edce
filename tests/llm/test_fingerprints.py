import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import empty, odd, rows  # noqa: F401
from millrace.llm import fingerprints
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def brute(texts):
    """(n_chars, digest of the edited text, near_edited, near_next) by multisets of pieces, texts in order."""
    found = []
    for k, text in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        near = []
        for other in (new, after):
            a, b = Counter(fingerprints.pieces(text)), Counter(fingerprints.pieces(other))
            both, all_ = sum((a & b).values()), sum((a | b).values())
            near.append(both / all_ if all_ else 1.0)
        found.append((len(text), hashlib.sha256(new.encode()).hexdigest(), *near))
    return found


def test_query_against_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    want = {d: b for (d, _), b in zip(docs, brute([t for _, t in docs]))}
    got = QUERIES["op12_lookup_sketches"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    prints = {}
    for r in got:
        assert (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) == want[r["doc_id"]], r["doc_id"]
        prints[r["doc_id"]] = r["fingerprint"]
    by_text = {}
    for d, t in docs:
        assert by_text.setdefault(t, prints[d]) == prints[d]
    assert len(set(by_text.values())) > 0.99 * len({tuple(sorted(fingerprints.pieces(t))) for t in by_text})
    near = np.array([[r["near_edited"], r["near_next"]] for r in got if r["n_chars"] > 100 and r["near_next"] < 1])
    assert (near[:, 0] > near[:, 1]).mean() > 0.99 and 0.2 < np.median(near[:, 0]) < 0.5


@pytest.mark.parametrize("ranges", [1, 3, 20])
def test_any_number_of_ranges(spark, ranges):
    texts = [f"text {k} has words. It has {k % 7} more of them" for k in range(40)] + ["same words here"] * 3
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    got = fingerprints.fingerprint_versions(given).collect()
    spark.conf.set("spark.sql.shuffle.partitions", held)
    want = [(k, *b) for k, b in enumerate(brute(texts))]
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got) == want


def test_odd_rows(spark, odd, empty):
    given = odd.union(odd.filter("doc_id = 7")).withColumnsRenamed({"shard": "range__", "kept": "key"})
    ordered = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in given.collect()), key=lambda r: (r[0], r[1], np.array(xxhash.xxh64_intdigest(r[2], 42), np.uint64).view(np.int64)))
    want = sorted((repr(None if none else d), *b) for (none, d, _), b in zip(ordered, brute([t for _, _, t in ordered])))
    got = fingerprints.fingerprint_versions(given)
    assert sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got.collect()) == want
    assert fingerprints.fingerprint_versions(empty).count() == 0
    one = fingerprints.fingerprint_versions(odd.filter("doc_id = 4").withColumn("text", F.lit("just one row of text"))).collect()
    assert [(r["n_chars"], r["near_next"]) for r in one] == [(20, 1.0)]


def test_peeling_finds_all_that_differs():
    random = np.random.default_rng(3)
    one, two = [], []
    for n in (0, 1, 5, 40, 700, 5000):
        for differ in (0, 1, n // 3, n):
            common = random.integers(0, 1 << 63, n).astype(np.uint64)
            one.append(np.unique(np.concatenate([common, random.integers(0, 1 << 63, differ).astype(np.uint64)])))
            two.append(np.unique(np.concatenate([common, random.integers(0, 1 << 63, differ // 2).astype(np.uint64)])))
    for a, b, (less, more) in zip(one, two, fingerprints.differences(one, two)):
        assert np.array_equal(less, np.setdiff1d(a, b)) and np.array_equal(more, np.setdiff1d(b, a))


def test_a_small_sketch_is_enough_for_small_differences():
    a = np.random.default_rng(4).integers(0, 1 << 63, (200, 3000)).astype(np.uint64)
    sketch = fingerprints.Sketches(list(a), fingerprints.CELLS)
    sketch.subtract(fingerprints.Sketches(list(a[:, 2:]), fingerprints.CELLS))
    rows, keys, signs, done = sketch.peel()
    assert done.mean() > 0.9 and (signs == 1).all()
    assert all(sorted(keys[rows == k]) == sorted(a[k, :2]) for k in np.flatnonzero(done))
