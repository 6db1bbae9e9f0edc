"""A corpus pipeline: quality classifier, exact deduplication, near-deduplication, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but
the last return the columns of ``documents``.

Defined cases, in every stage: a null text counts as empty; an empty table gives an empty result;
texts of any length are read whole; of rows that repeat doc_id and text one stays after the stage
``exact_dedup``, and a null doc_id loses there and in ``simhash`` against any other; ties are
decided by doc_id; further columns, whatever their names, are passed through by all stages but the
last, which leaves them out.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, pii, quality, simhash_wide
from tidemark.llm._spark import remove, scratch, shared_dir, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from all labels."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by similarity (five words, Jaccard >= 0.8) the document with the smallest doc_id stays.

    Candidates are found by fingerprints: shards named by their clearest votes, a BK-tree searched in
    each; they are compared by whole sets, as a SimHash distance alone does not tell that similarity.
    """
    return simhash_wide.drop_near_duplicates(docs, least=(4, 5))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced in the text."""
    return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_classifier),
    ("exact_dedup", exact_deduplication),
    ("simhash", near_deduplication),
    ("personal_data", personal_data),
    ("packing", best_fit_packing),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again.

    What a stage wrote for itself goes when its result is written, and that result goes when the next
    one is, so only the last one stays.
    """
    docs = table(spark, sf_dir, "documents")
    base, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            remove(spark, before)
        before = f"{base}/{name}"
    return docs
