import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from cases import empty, odd, rows  # noqa: F401
from millrace.llm import bpe
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.01"
FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    "", " ", "  a", "a  ", "a \n b", "x<|endoftext|>y", "a  <|endoftext|> \n", "İstanbul ΑΣ Ⅷ", "it's 'RE don't I'LL", "\x1c!\x1c!", "é ́x", "中文字符测试 日本語",
    "\U0001f600\U0001f44d\U0001f3fd ok", "a\xa0b   　c", "<|startoftext|> hi", "a\tb\r\nc", "123 4567 ١٢٣", "ß ẞ", "a" * 300, "ab" * 40, "\x00\x01", "ſ's", "</w>", "a</w> b",
]


@pytest.mark.parametrize("trie", [True, False])
@pytest.mark.parametrize("file", FILES)
def test_ids_equal_the_library(file, trie):
    path = public_tokenizers.path(file)
    library, own = Tokenizer.from_file(path), bpe.encoder(path, trie)
    random.seed(5)
    texts = ODD + ["".join(random.choice("abcdefgh  \n\t'.,!é中\U0001f600́\x1c\xa0019_<|>") for _ in range(random.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(random.choice("etaoin shrdlu") for _ in range(random.randint(1, 80))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, np.uint32).tolist() == want, repr(text)
        if file.startswith("byte"):
            assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 20)
    monkeypatch.setattr(bpe, "BATCH_CHARS", 50)
    path = public_tokenizers.path(FILES[0])
    texts = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(30)] * 2
    assert bpe.Encoder(path).encode(texts) == bpe.encoder(path).encode(texts)


def test_tokens_that_follow_are_what_merging_gives():
    merges = bpe.encoder(public_tokenizers.path(FILES[0])).merges
    random.seed(2)
    names = [n for n in merges.names if 1 < len(n) < 9]
    for _ in range(3000):
        word = random.choice(names) + random.choice(names)
        assert np.frombuffer(merges.encode_words([word])[word], np.uint32).tolist() == merges.merge(word)


def test_query_equals_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((d["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(QUERIES["op4_trie_bpe"](spark, SF_DIR)) == sorted(want, key=repr)


def test_odd_rows(spark, odd, empty):
    path = public_tokenizers.path(FILES[0])
    back = odd.withColumn("ids", bpe.encode(F.col("text"), path)).withColumn("back", bpe.decode(F.col("ids"), path))
    assert all(r["back"] == (r["text"] or "") for r in back.collect())
    assert empty.select(bpe.encode(F.col("text"), path)).count() == 0
