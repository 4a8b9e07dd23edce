import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import empty, odd, plan  # noqa: F401
from millrace.llm import packing
from millrace.llm.queries import QUERIES, WORD_BPE, piece_digests
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.01"


def place(plan):
    """Sequences and items that a plan makes."""
    sequences, items = {}, {}
    for length, begin, end, skip, take, nth, each, sequence, offset in plan:
        for item in range(begin, end):
            j = item - begin + nth
            sequences.setdefault(sequence + j // each, []).append((offset + j % each * take, take))
            items.setdefault((length, item), []).append((skip, take))
    return sequences, items


def gapless(parts):
    at = 0
    for start, size in sorted(parts):
        assert start == at and size > 0
        at += size
    return at


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 4000), (3, 1)])
def test_plan_places_every_id_once(seed, hot):
    random.seed(seed)
    counts = {}
    for _ in range(2000 if hot != 1 else 0):
        n = min(2048, max(1, int(random.lognormvariate(6, 1.2))))
        counts[n] = counts.get(n, 0) + 1
    counts[777] = counts.get(777, 0) + hot
    sequences, items = place(packing.plan_windows(counts))
    assert all(gapless(p) <= 2048 for p in sequences.values())
    assert len(items) == sum(counts.values()) and all(gapless(p) == n for (n, _), p in items.items())
    assert sum(2048 - gapless(p) for p in sequences.values()) < 2048 + packing.LEAST_CUT * len(sequences)


@pytest.mark.parametrize("seed", range(20))
def test_fill_is_the_best_subset(seed):
    random.seed(seed)
    counts = {random.randint(1, 30): random.randint(1, 3) for _ in range(4)}
    sums = {0}
    for n, c in counts.items():
        sums = {s + k * n for s in sums for k in range(c + 1)}
    taken = packing.fill(counts, 50)
    assert all(taken[n] <= counts[n] for n in taken)
    assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= 50)


def check(rows, texts):
    """Pieces against the library's ids; returns the padding's share."""
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert gapless([(r["start"], r["length"]) for r in by_doc[doc]]) == len(ids)
        for r in by_doc[doc]:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    used = [gapless(p) for p in by_sequence.values()]
    assert max(used) <= 2048 and sorted(by_sequence) == list(range(len(by_sequence)))
    return 1 - sum(used) / (2048 * len(used))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert check(QUERIES["op2_min_bin_slack"](spark, SF_DIR).collect(), texts) < 0.01


def test_odd_rows(spark, odd, empty):
    path = public_tokenizers.path(WORD_BPE)
    texts = {n: r["text"] for n, r in enumerate(odd.collect())}
    numbered = spark.createDataFrame([(n, t, "x", 5) for n, t in texts.items()], "doc_id long, text string, ids string, length int")
    pieces = packing.cut(numbered, path, "text", ["doc_id"])
    check(piece_digests(pieces).collect(), texts)
    whole = packing.sequences(packing.place(packing.cut(numbered, path))).collect()
    assert all(len(r["ids"]) == 4 * sum(r["lengths"]) <= 4 * 2048 for r in whole)
    assert piece_digests(packing.cut(empty, path, "text", ["doc_id"])).count() == 0


def test_forgetting_changes_no_ids(spark, odd):
    path = public_tokenizers.path(WORD_BPE)
    kept, forgotten = (packing.cut(odd, path, "text", ["doc_id"], forget=f).select("doc_id", "start", "ids") for f in (False, True))
    assert kept.exceptAll(forgotten).isEmpty() and forgotten.exceptAll(kept).isEmpty()
