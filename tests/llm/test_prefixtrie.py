import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import rows
from millrace.llm import prefixtrie
from millrace.llm.queries import QUERIES, share_heads

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def gathered(turns):
    """conv -> its turns, in order."""
    found = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(rows, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, rows in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(held) - 1) * words
    return sorted([(
        min(held), len(node), min(members[node[:-1]]) if node else None, len(held), kids[node], leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
    ) for node, held in members.items()], key=repr)


def test_query_against_brute_force(spark):
    given = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op13_zfast_trie"](spark, SF_DIR)
    assert rows(got.select(*COLUMNS)) == brute(rebuilt(gathered(given)))


def chats(seed, n, length=8, kinds=3):
    made = random.Random(seed)
    return [(c, t, "user", f"said {made.randrange(kinds)} " * made.randrange(1, 3)) for c in range(n) for t in range(made.randrange(1, length))]


@pytest.mark.parametrize("segment, bits", [(1024, 12), (2, 12), (4, 2), (1, 0)])
def test_segments_and_batches_change_nothing(spark, monkeypatch, segment, bits):
    monkeypatch.setattr(prefixtrie, "SEGMENT", segment)
    monkeypatch.setattr(prefixtrie, "BATCH_BITS", bits)
    given = chats(segment, 150) + [(1000 + k, t, "a", f"long {t}") for k in range(3) for t in range(40 - k)]
    turns = prefixtrie.number_turns(spark.createDataFrame(given, "conv_id long, turn long, role string, text string"))
    trie = prefixtrie.build_trie(turns, turns.select("conv").distinct())
    assert rows(trie.select(*COLUMNS)) == brute(gathered(given))


def test_odd_rows(spark):
    long = "many words " * 100_000
    given = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "", ""), (1, 1, "", ""), (2, None, "user", "first"), (2, 0, "", ""), (None, 0, "user", "nobody"),
        (3, 0, "user", long), (4, 0, "user", long), (20, 5, "user", "a"), (21, 1, "user", "b"), (22, 1, "user", "c\x0bd"), (-3, 0, "user", "first"), (47, 2, None, "x"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id long, turn long, role string, text string, part string, pos long")
    turns, convs = share_heads(prefixtrie.number_turns(frame))
    held = gathered(given)
    want = {}
    for c, said in held.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        want[c] = held.get(base, [])[:h] + said[h:]
    assert rows(prefixtrie.build_trie(turns, convs).select(*COLUMNS)) == brute(want)
    turns, convs = share_heads(prefixtrie.number_turns(frame.limit(0)))
    assert prefixtrie.build_trie(turns, convs).count() == 0


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 41):
            most = max(range(a + 1, b + 1), key=lambda n: n & -n)
            assert prefixtrie.two_fattest(np.array([a]), np.array([b])).tolist() == [most]


def test_few_rounds_for_many_strings():
    made = np.random.default_rng(1)
    hi = made.integers(1, 60, 3000)
    starts = np.cumsum(hi + 1) - (hi + 1)
    keys = []
    for n in hi:
        keys.append(0)
        for step in made.integers(1, 4, n):
            keys.append(xxhash.xxh64_intdigest(f"{keys[-1]} {step}") >> 1)
    keys = np.array(keys, np.int64)
    last = keys[starts + hi]
    keep = np.sort(np.unique(np.stack([last, hi]), axis=1, return_index=True)[1])
    trie = prefixtrie.ZFastTrie(keys, keys, starts[keep], np.zeros(len(keep), np.int64), hi[keep])
    trie.insert(np.arange(len(keep)))
    length, place, n, _ = trie.expand(np.ones(len(keep), np.int64), np.arange(len(keep)))
    want = defaultdict(int)
    for s in keep:
        for d in range(1, hi[s] + 1):
            want[d, keys[starts[s] + d]] += 1
    assert dict(zip(zip(length.tolist(), keys[place].tolist()), n.tolist())) == want
    assert trie.rounds < 25
