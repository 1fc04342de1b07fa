"""Cleaning a corpus: five stages, each written and read again before the next.

quality     rows below the quality cut go
exact       of equal texts the largest id stays
near        of texts that link by shingles the smallest id stays
secrets     secrets in texts are replaced by a mark, n_chars follows
packing     the last stage: pieces of all documents in sequences for training
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenomill.llm import exact_index, jaccard_links, packing, quality_mil, secret_scan
from phenomill.llm.common import table, written

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels of the given documents."""
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    return quality_mil.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_index.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard_links.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    clean = secret_scan.redact(docs, public_tokenizers.path(RANKS))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the sequences."""
    return packing.packed_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets), ("packing", packing_stage)]

# Scores and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
