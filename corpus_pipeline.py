"""The corpus pipeline: five stages from raw documents to a weighted mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read back as the next
stage's docs. All but the last return the columns of documents. Stages are judged on their own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceframe.llm import decontaminate, line_dedup, minhash_dedup, mixing, quality
from priceframe.llm.textkit import fresh, read, shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without repeated passages of two or more lines; n_chars counts the new text."""
    out = line_dedup.remove(docs, cut=None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return minhash_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken: its columns, domain, n_tokens and epoch."""
    mixed = mixing.mix(docs, mixing.domain_of(F.col("source")), **mixing.PRODUCTION)
    more = [F.col(c).alias(fresh(c, docs.columns)) for c in ("domain", "n_tokens", "epoch")]
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns], *more)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_near),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
]

#: The classifier cannot be written in SQL; tests compare the stages after it with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
