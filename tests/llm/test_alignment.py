import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import empty, odd, rows  # noqa: F401
from millrace.llm import alignment
from millrace.llm.bpe import byte_symbols
from millrace.llm.queries import QUERIES
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.01"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a", "a  ", "a \n b", "x<|endoftext|>y </s> <0x41>", "a;\r\nb", "\r", "a\r  b", "\n\nword", "a\u2581b", "\u2581", "é ́x", "中文字符测试 日本語", "\U0001f600\U0001f44d ok",
    "a\xa0b   　c", "123 4567 ١٢٣", "İstanbul ΑΣ", "a" * 3000, "ab " * 400, "\x00\x01", "\x1c!\x1c!", "a\x0bb\x0cc\x85d", "it's 'RE don't",
]


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, b


def brute(libraries, texts):
    """The groups of each text, from both libraries' own ids; None where bytes differ."""
    a, b = libraries
    back, found = {s: n for n, s in enumerate(byte_symbols())}, []
    for text in texts:
        sides = []
        if text:
            one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            sides = [
                [(i, bytes(back[c] for c in a.id_to_token(i))) for i in one],
                [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()) for i in two],
            ]
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in sides):
            sides = []
        ends = [np.cumsum([len(t) for _, t in side]) for side in sides]
        groups, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])) if sides else ():
            to = [int(np.searchsorted(e, cut)) + 1 for e in ends]
            groups.append(tuple([i for i, _ in side[s:e]] for side, s, e in zip(sides, at, to)))
            at = to
        found.append(groups)
    return found


def expected(groups):
    pairs = [[(x, y) for one, two in g for x in one for y in two] for g in groups]
    count = Counter(p for held in pairs for p in set(held))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    return [(
        sum(len(one) for one, _ in g), sum(len(two) for _, two in g), len(g), len(held),
        ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in g),
        sum(count[p] == most[p[0]] for p in held), sum(count[p] for p in held),
    ) for g, held in zip(groups, pairs)]


def test_query_against_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = expected(brute(libraries, [d["text"] for d in docs]))
    want = [(d["doc_id"], *w[:4], w[5], w[6], hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "") for d, w in zip(docs, want)]
    assert rows(QUERIES["op11_lockstep_alignment"](spark, SF_DIR)) == sorted(want, key=repr)


def test_ids_equal_the_libraries(libraries):
    engine = alignment.Encoders(*PATHS)
    texts = ODD + ["".join(np.random.default_rng(k).choice(list("abcdefgh  \n\t\r'.,!é中́\x1c\xa0\u258119_<|>"), 50)) for k in range(800)]
    for start in range(0, len(texts), 100):
        part = texts[start:start + 100]
        a, rows_a, b, rows_b = engine.encode(part)
        for k, groups in enumerate(brute(libraries, part)):
            assert a[rows_a[k]:rows_a[k + 1]].tolist() == [i for one, _ in groups for i in one], repr(part[k])
            assert b[rows_b[k]:rows_b[k + 1]].tolist() == [i for _, two in groups for i in two], repr(part[k])


def test_odd_texts_and_columns(spark, libraries, odd, empty, monkeypatch):
    given = odd.union(odd.limit(1)).withColumnsRenamed({"shard": "chunk__", "kept": "n_best"})
    texts = [r["text"] for r in given.collect()]
    want = expected(brute(libraries, texts))
    got = alignment.align(given, *PATHS)
    assert "n_best" in got.columns and "chunk__" in got.columns and got.count() == len(texts)
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert rows(got.select(*names)) == sorted(want, key=repr)
    assert rows(alignment.align(spark.createDataFrame([(t,) for t in ODD], "text string"), *PATHS).select(*names)) == sorted(expected(brute(libraries, ODD)), key=repr)
    assert alignment.align(empty, *PATHS).count() == 0


def test_small_caches_and_large_groups_change_nothing(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 30)
    small, engine = alignment.Encoders(*PATHS), alignment.encoders(*PATHS)
    texts = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(30)]
    for _ in range(2):
        assert all(np.array_equal(x, y) for x, y in zip(small.encode(texts), engine.encode(texts)))
    groups, doc = np.array([[0, 3, 0, 2], [3, 5, 2, 5]]), np.array([0, 0])
    a, b = np.array([7, 7, 8, 7, 9]), np.array([1, 2, 1, 1, 2])
    plain = alignment.links(groups, doc, a, b, 10)
    monkeypatch.setattr(alignment, "_PLAIN_LINKS", 0)
    assert all(np.array_equal(x, y) for x, y in zip(plain, alignment.links(groups, doc, a, b, 10)))
    count = Counter((7 * 10 + 1, 7 * 10 + 2, 8 * 10 + 1, 8 * 10 + 2)[k] for k in (0, 1, 0, 1, 2, 3)) + Counter({71: 2, 72: 1, 91: 2, 92: 1})
    assert dict(zip(plain[1].tolist(), plain[2].tolist())) == dict(count)
