"""The registered queries of the corpus operators: op1 to op13."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bpe, chat, fingerprints, licences, packing, prefixtrie, quality, secrets, sharding, simhash, topk, warc
from millrace.llm.common import bound_batches
from millrace.llm.oracles import OP3, OP5, OP7, OP8
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def query(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_min_cost_reshard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six shards by doc_id become eight of equal bytes; a boundary is off by half a row at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(6)).cast("int")
    keys = [F.col("doc_id"), F.crc32(F.col("text").cast("binary"))]
    layout = sharding.write_shards(docs, old, sharding.row_bytes(F.col("text")), 6, keys)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    rows = sharding.reshard(layout, shards=8).read(["doc_id"], sharding.row_bytes(F.col("text")).alias("size"), crc)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def piece_digests(pieces: DataFrame, window: int = packing.WINDOW) -> DataFrame:
    """Pieces in their places, with the checksum of their ids.

    Whole windows are never cut again, so their checksums travel in place of
    their ids.
    """
    full = F.col("length") == window
    pieces = pieces.withColumns({"full_crc32": F.when(full, F.crc32("ids")), "ids": F.when(~full, F.col("ids"))})
    placed = packing.place(pieces, window)
    return placed.withColumn("ids_crc32", F.coalesce("full_crc32", F.crc32("ids"))).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_min_bin_slack")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_digests(packing.cut(docs, public_tokenizers.path(WORD_BPE), "text", ["doc_id"]))


@query("op3_revisit_resolution", OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    warc.write_archives(warc.resolve(pages), path)

    records = warc.read_archives(spark, path)
    body = F.col("content").cast("binary")
    response = F.col("record_type") == "response"

    def page(urn: str) -> Column:
        return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        F.when(response, F.octet_length(body).cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha1(body)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


@query("op4_trie_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    path = public_tokenizers.path(BYTE_BPE)
    encoded = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), path).alias("ids"))
    decoded = encoded.select("doc_id", "ids", bpe.decode(F.col("ids"), path).alias("text"))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op5_uniform_threshold", OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), topk.whole_vectors(rows).alias("vec"))
    return topk.top_k(rows, F.col("vec_id") % 20 == 0, 20)


@query("op6_weak_supervision")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_typed_parts", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    more = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(probe).alias("text")) for n, role in enumerate(("user", "assistant"))]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.range(1).select(F.inline(F.array(*more))))
    read = chat.read_back(chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text")))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


@query("op8_licence_digests", OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "unit", "line", "digest", "licence")


@query("op9_format_automata")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    formats = secrets.learn(docs)
    rows = docs.select("doc_id", secrets.find_secrets(F.col("text"), formats).alias("found"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "format")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query("op10_simhash_trie")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


@query("op11_lockstep_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths, columns=["doc_id"], digest=True)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query("op12_lookup_sketches")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = fingerprints.fingerprint_versions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return versions.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op13_zfast_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = share_heads(prefixtrie.number_turns(table(spark, sf_dir, "conversations")))
    return prefixtrie.build_trie(turns, conversations)


def share_heads(turns: DataFrame, most: int = 4, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with its first h turns replaced by those of c - c % every, h being below ``most``; and all conversations."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    own = sizes.select("conv", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    given = own.join(sizes.select(F.col("conv").alias("base"), "n"), "base", "left").withColumn("m", F.least("h", F.coalesce("n", F.lit(0))))
    kept = turns.join(given.select("conv", "h", "m"), "conv").filter("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "a", "b", "words")
    heads = turns.filter(F.col("pos") < most - 1).withColumnRenamed("conv", "base").join(given.select("base", "conv", "m"), "base").filter("pos < m").select("conv", "pos", "a", "b", "words")
    return kept.union(heads), sizes.select("conv")
