"""A corpus pipeline: the documents that are good, once each, mixed to target weights, encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, rules, simhash
from tidemark.llm.queries import good_labels, trusted_documents
from tidemark.plans.storage import scratch_dir, store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; the source is the host, the language the path in it."""
    return quality.accepted(docs, good_labels(spark, sf_dir), scratch_dir(spark))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio to the trusted ones."""
    return rules.passing(docs, trusted_documents(spark, sf_dir), scratch_dir(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash.one_of_each(docs, scratch_dir(spark))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs, scratch_dir(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their number for every row, and whether the decoded text is the text."""
    ids = bpe.encode_documents(docs)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", decoded)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", encoding),
]

#: Neither the classifier's fit nor SimHash's hashes can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written and read again as the next stage's documents."""
    folder = scratch_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = store(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
