"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, embedding_dedup, filter_audit, line_dedup, minhash_dedup, mixing, oracles, packing, pii, quality, substring_dedup, suffix_dedup, warc
from .textkit import read, shared_dir

#: Where the public vocabularies are, on the driver and on every executor.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, read(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.cluster(read(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.digest(spark, path)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.cluster(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, mixing.domain_of(F.col("source")), **mixing.PRODUCTION)
    return mixed.select("row.doc_id", "domain", "row.lang", "row.source", "n_tokens", F.col("epoch").cast("int").alias("epoch"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find(docs, read(spark, sf_dir, "benchmark")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, read(spark, sf_dir, "labels"))


def op13_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.place(docs, vocabulary or f"{TOKENIZERS}/word_bpe_49k.json")


QUERIES = {f.__name__: f for f in (op1_quality, op2_pii, op3_substring_dedup, op4_line_dedup, op5_embedding_dedup, op6_warc, op7_minhash_dedup, op8_mixing, op9_suffix_dedup, op10_decontaminate, op11_collocations, op12_filter_audit, op13_packing)}

ORACLE_SQL = oracles.ORACLE_SQL
