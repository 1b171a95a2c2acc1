"""A training corpus from documents: quality, near-duplicates, personal data, mixture, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leafline.llm import op3_pii, op4_mixing, op5_simhash, op6_quality, op7_packing
from leafline.llm.common import materialize, read

#: What the mixture counts and packing packs.
TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the ordinal classifier keeps."""
    return op6_quality.keep_good(docs, op6_quality.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), the one of the smallest doc_id: op5's links of
    fingerprints propose them, bands of min-wise hashes those that are further apart, and shingle sets decide."""
    return op5_simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    return op3_pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of languages below their target more often."""
    fitted, _ = op4_mixing.fit(docs, op4_mixing.labelled_domains(docs, read(spark, sf_dir, "labels")), public_tokenizers.path(TOKENIZER))
    return op4_mixing.mix(docs, fitted, least=1)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return op7_packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", packing),
]

#: SQL can't express the stages; tests/llm/test_queries.py runs all of them on a small table and holds each one's rows
#: against its predecessor's by plain Python (the classifier's verdicts against op6_quality's own).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
