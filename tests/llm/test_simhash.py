import random
import re

import numpy as np
import pytest
import xxhash
from cases import empty, odd, rows  # noqa: F401
from millrace.llm import simhash
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, budget=3):
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    x = np.array(prints, np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= budget)):
        label[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def clusters(seed, bases, each, flips):
    random.seed(seed)
    found = set()
    for _ in range(bases):
        base = random.getrandbits(64)
        found.add(base)
        for _ in range(each):
            x = base
            for _ in range(random.randint(1, flips)):
                x ^= 1 << random.randrange(64)
            found.add(x)
    return sorted(found)


@pytest.mark.parametrize("bases,each,flips", [(200, 8, 5), (1, 1500, 4), (0, 0, 1)])
def test_trie_join_equals_all_pairs(bases, each, flips):
    x = np.array(clusters(3, bases, each, flips), np.uint64)
    if len(x):
        got = simhash.trie_join(x, np.array([[0, len(x), 0, len(x)]]), 0, 3)
        assert got.tolist() == brute_groups(x)


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_links_join_the_components(spark, bucket_rows):
    x = clusters(5, 40, 12, 4)
    signed = [int(v) for v in np.array(x, np.uint64).view(np.int64)]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = dict(rows(simhash.connected(simhash.links(frame, len(x), 3, bucket_rows))))
    want = {}
    for v, g in zip(signed, brute_groups(x)):
        want.setdefault(g, set()).add(v)
    got = {}
    for v in signed:
        got.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_print(d["text"]) for d in docs]
    want = sorted((d["doc_id"], f"{p:016x}", docs[g]["doc_id"]) for d, p, g in zip(docs, prints, brute_groups(prints)))
    assert rows(QUERIES["op10_simhash_trie"](spark, SF_DIR)) == sorted(want, key=repr)


def test_odd_rows(spark, odd, empty):
    got = simhash.near_groups(odd, member=F.col("doc_id"))
    assert got.columns == [c for c in odd.columns if c != "fingerprint"] + ["fingerprint", "first"] and got.count() == odd.count()
    by_text = {r["text"]: r for r in got.collect()}
    assert by_text[None]["fingerprint"] == by_text[""]["fingerprint"] == by_text[" \n\t "]["fingerprint"] == 0 and by_text[""]["first"] == 0
    assert by_text["a"]["first"] is None  # its group has no other doc_id
    assert simhash.near_groups(empty).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    prints = [brute_print(r["text"]) for r in odd.collect()]
    assert kept.count() == len(set(brute_groups(prints)))
    assert simhash.keep_first(empty).count() == 0


def test_majority_equals_the_fingerprint():
    texts = ["", "one two three", "a b c d e f g h", " ".join(f"w{k}" for k in range(900))]
    for text in texts:
        words = text.split()
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64)
        assert simhash.majority(hashes) == simhash.fingerprint(text) == brute_print(text)


def test_group_pairs_span_the_components(spark):
    x = clusters(7, 30, 12, 9)
    signed = np.array(x, np.uint64).view(np.int64).tolist()
    members = [(key, 0, n, v) for n, v in enumerate(signed) for key in {n % 3, 7}]
    members += [(7, 0, 10_000 + n, signed[n]) for n in range(5)] + [(7, 0, 0, signed[0]), (8, 0, 3, signed[3]), (9, 2, 4, signed[4]), (9, 1, 5, signed[4])]
    frame = spark.createDataFrame(members, "key long, chunk int, node long, fingerprint long").repartition(4)
    found = [(r["a"], r["b"]) for r in simhash.group_pairs(frame, len(members), (3, 12)).collect()]
    value = lambda n: x[n % 10_000]
    assert all((value(a) ^ value(b)).bit_count() <= 12 for a, b in found)
    top = dict.fromkeys(range(len(x)))
    top = {n: n for n in top}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in found:
        if max(a, b) < 10_000:
            top[max(root(a), root(b))] = min(root(a), root(b))
    assert [root(n) for n in range(len(x))] == brute_groups(x, 12)
    assert {tuple(sorted(p)) for p in found if max(p) >= 10_000} == {(n, 10_000 + n) for n in range(5)}
    assert len(found) <= 2 * len(x) + 5  # a forest in the group of all and one in each of the three
