import random

import corpus_pipeline
import numpy as np
from cases import empty, odd  # noqa: F401
from millrace.llm import minhash


def sets(texts, words=5):
    found = []
    for text in texts:
        split = (text or "").lower().split()
        found.append({tuple(split[i:i + words]) for i in range(max(1, len(split) - words + 1))} if split else set())
    return found


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_groups(texts, least=0.8):
    found, label = sets(texts), list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if similarity(found[i], found[j]) >= least:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


def copies(seed, bases, each):
    """Texts of 60 to 500 words, each with copies in which some words are replaced: similarities around 0.8 and more."""
    random.seed(seed)
    word = lambda: f"w{random.randrange(5000)}"
    texts = []
    for _ in range(bases):
        base = [word() for _ in range(random.choice([60, 100, 200, 500]))]
        texts.append(" ".join(base))
        for _ in range(each):
            copy = list(base)
            for at in random.sample(range(len(copy)), random.randint(1, max(1, len(copy) // 40))):
                copy[at] = word()
            texts.append(" ".join(copy))
    random.shuffle(texts)
    return texts


def kept(spark, texts):
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    return sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect())


def test_stage_equals_all_pairs(spark):
    texts = copies(1, 60, 4) + copies(2, 2, 60) + [None, "", "one two", "One  two", "one two three"]
    found = sets(texts)
    near = [similarity(a, b) for k, a in enumerate(found) for b in found[:k] if a | b]
    assert sum(0.8 <= s < 0.9 for s in near) > 200 and sum(0.6 < s < 0.8 for s in near) > 200
    assert kept(spark, texts) == sorted(set(brute_groups(texts)))


def test_members_that_no_pivot_resembles(spark):
    base = [f"w{k}" for k in range(120)]
    chain = [" ".join(base[k:k + 60]) for k in range(0, 61, 5)]  # neighbours are similar, the ends aren't
    assert kept(spark, chain) == sorted(set(brute_groups(chain))) == [0]
    assert kept(spark, chain[::2]) == sorted(set(brute_groups(chain[::2])))


def test_a_shared_passage_brings_no_pairs(spark):
    random.seed(5)
    passage = [f"p{k}" for k in range(40)]
    texts = [passage + [f"w{random.randrange(10**6)}" for _ in range(15)] for _ in range(600)]
    texts += [[*t[:50], "changed", *t[51:]] for t in texts[:100]]
    rows = [(n, n, sorted({hash(tuple(t[i:i + 5])) for i in range(len(t) - 4)})) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "node long, root long, set array<long>")
    pairs = {(r["a"], r["b"]) for r in minhash.rare_pairs(frame, 0.8).collect()}
    found = sets([" ".join(t) for t in texts])
    near = {(a, b) for b in range(len(found)) for a in range(b) if similarity(found[a], found[b]) >= 0.8}
    assert len(near) >= 100 and near <= pairs and len(pairs) < 2 * len(texts)


def test_recall_of_the_bands():
    random.seed(3)
    near = found = 0
    for _ in range(600):
        one = set(random.sample(range(1 << 60), 300))
        two = set(random.sample(sorted(one), 267)) | set(random.sample(range(1 << 60), 33))
        if similarity(one, two) < 0.8:
            continue
        near += 1
        found += bool(set(minhash.band_keys(np.array(sorted(one), np.uint64)).tolist()) & set(minhash.band_keys(np.array(sorted(two), np.uint64)).tolist()))
    assert near == 600 and found >= 599


def test_odd_and_empty(spark, odd, empty):
    rows = odd.collect()
    out = minhash.keep_first(odd)
    assert out.columns == odd.columns
    assert out.count() == len(set(brute_groups([r["text"] for r in rows])))
    assert minhash.keep_first(empty).count() == 0


def test_pairs_are_named_by_tries_of_fingerprints(spark, monkeypatch):
    texts = copies(4, 30, 3) + copies(6, 1, 400)
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    named = {}
    for at, name in ((minhash.simhash, "links"), (minhash.simhash, "group_pairs")):
        def spy(*given, f=getattr(at, name), name=name):
            named[name] = f(*given)
            return named[name]

        monkeypatch.setattr(at, name, spy)
    rest = []
    rare = minhash.rare_pairs
    monkeypatch.setattr(minhash, "rare_pairs", lambda sets, least: rest.append(sets.select("root").distinct().count()) or rare(sets, least))
    got = minhash.keep_first(frame).count()
    assert got == len(set(brute_groups(texts)))
    assert named["links"].count() > 0 and len(texts) / 2 < named["group_pairs"].distinct().count() < 8 * len(texts)
    assert rest[0] < len(texts) / 10  # what the tries' links leave apart
