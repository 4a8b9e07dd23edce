"""A corpus pipeline: quality rules, near-duplicates, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import minhash, packing, quality, secrets
from millrace.llm.common import col, unused
from millrace.llm.queries import WORD_BPE
from millrace.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak supervision keeps."""
    # Under other names the documents' columns keep their values where the verdict has columns of these names too.
    own = {c: f"own_{n}__" for n, c in enumerate(docs.columns)}
    judged = quality.judge(docs.select(*[col(c).alias(own[c]) for c in own]), text=own["text"])
    return judged.filter("kept").select(*[col(own[c]).alias(c) for c in own])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8 and more), that with the smallest doc_id."""
    return minhash.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by its kind; n_chars counts anew where a text changes."""
    formats = secrets.learn(docs)
    found, text = unused(docs, "found__", "text__")
    clean = docs.withColumn(found, secrets.find_secrets(F.col("text"), formats))
    clean = clean.withColumn(text, secrets.redact(F.col("text"), col(found)))
    values = {"text": col(text), "n_chars": F.when(F.size(found) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return clean.select(*[values[c].alias(c) if c in values else col(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' token sequences with their ids, each with its place and the checksum of its ids."""
    placed = packing.place(packing.cut(docs, public_tokenizers.path(WORD_BPE), "text", ["doc_id"], forget=True))
    return placed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("packing", pack)]

#: None of the stages but the first can be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each over what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
