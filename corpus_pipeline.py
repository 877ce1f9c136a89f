"""Corpus pipeline: quality rules, near-dedup, decontamination, PII and BPE, over documents.

Each stage works on what the one before kept. Near-dedup keeps one row of each
group; in the other stages, rows that repeat doc_id and text share the decision.
All stages but the last return all columns of documents, whatever their names.
Null and empty texts fail the quality rules; texts of any length are used whole;
null ids are kept; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waymark.llm.bpe import bpe_round_trip
from waymark.llm.common import documents, materialize
from waymark.llm.decontamination import decontaminate
from waymark.llm.near_copies import drop_near_copies
from waymark.llm.pii_bootstrap import redact
from waymark.llm.quality_rules import keep_good

WORD_BPE = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more.

    SimHash fingerprints and their vantage-point trees bring copies together; an exact join finds what is further apart.
    """
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document that is left."""
    return bpe_round_trip(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]

#: The stages use sketches, exact set joins and tokenizers that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
