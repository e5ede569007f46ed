"""Documents to packed token sequences: each stage is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.llm import packing, quality, repeats, rules, simhash
from postloom.llm.common import table, written
from postloom.llm.queries import BPE


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.accepted(docs, quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject; cutoffs are certified on all labelled documents."""
    return rules.accepted(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints linked within 3 bits, over 3-word shingles (op3's contract)."""
    return simhash.keep_one(docs, radius=3, shingle=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that are met more than once."""
    return repeats.removed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs.select("doc_id", "text"), BPE)


STAGES = [
    ("quality_classifier", good_documents),
    ("quality_rules", within_rules),
    ("simhash_dedup", one_of_each),
    ("suffix_array_dedup", without_repeats),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
