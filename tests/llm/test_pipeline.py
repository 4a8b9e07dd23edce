import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from cases import empty, odd  # noqa: F401
from millrace.llm import packing
from millrace.llm.queries import WORD_BPE
from test_minhash import brute_groups
from test_packing import check
from test_quality import brute as base
from test_secrets import brute as base_secrets
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "secret_scan", "packing"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    given, frame, out = {r["doc_id"]: r for r in docs.collect()}, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, frame, SF_DIR).write.parquet(path)
        frame = spark.read.parquet(path)
        out[name] = {r["doc_id"]: r for r in frame.collect()} if name != "packing" else frame.collect()
        if name != "packing":
            assert frame.columns == docs.columns
    good = out["quality_rules"]
    assert all(good[d] == given[d] and not base(given[d]["text"])[5] for d in good)
    assert all(d in good for d in given if labels.get(d) == 1 and not base(given[d]["text"])[5])
    assert not any(labels.get(d) == 0 for d in good)
    ordered = sorted(good)
    groups = brute_groups([good[d]["text"] for d in ordered])
    assert out["near_duplicates"] == {ordered[g]: good[ordered[g]] for g in set(groups)}
    clean = out["secret_scan"]
    assert set(clean) == set(out["near_duplicates"])
    for d, r in clean.items():
        assert not base_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        if not base_secrets(given[d]["text"]) and "[format]" not in r["text"]:
            assert r == given[d]
    assert check(out["packing"], {d: r["text"] for d, r in clean.items()}) < 0.01


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_documents(spark, odd, empty, kind):
    frame = {"odd": odd, "empty": empty}[kind]
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, frame, SF_DIR)
        if name != "packing":
            assert got.columns == frame.columns
        assert got.count() >= (0 if kind == "empty" or name == "quality_rules" else 5)


def test_documents_keep_their_own_columns(spark, odd):
    names = {"shard": "found__", "fingerprint": "text__", "kept": "votes", "lang": "stays", "source": "n_words"}
    frame, words = odd.withColumnsRenamed(names), "word " * 3
    more = spark.createDataFrame([(900 + k, f"{words}{k} " + " ".join(f"w{k}x{j}." for j in range(90)), "v", "w", 5, 6, "y", "q") for k in range(4)], odd.schema)
    frame = frame.union(more)
    own = [c for c in frame.columns if c not in ("text", "n_chars")]
    given = {tuple(r) for r in frame.select(own).collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, frame, SF_DIR)
        assert got.dtypes == frame.dtypes
        kept = {tuple(r) for r in got.select(own).collect()}
        assert len(kept) >= 4 and kept <= given, name


def test_packing_gives_every_id_its_place(spark, odd):
    texts = {n: r["text"] for n, r in enumerate(odd.collect())}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    placed = corpus_pipeline.pack(spark, docs, SF_DIR)
    pieces = placed.collect()
    library = Tokenizer.from_file(public_tokenizers.path(WORD_BPE))
    for doc, text in texts.items():
        own = sorted((r["start"], bytes(r["ids"])) for r in pieces if r["doc_id"] == doc)
        assert np.frombuffer(b"".join(ids for _, ids in own), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids + [1]
    assert any(r["length"] == packing.WINDOW for r in pieces)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] for r in pieces)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(placed).collect()}
    for r in pieces:
        assert whole[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == r["ids"]
