"""The corpus pipeline: five operators applied in turn to ``documents``.

Quality rules drop what they reject, near-dedup leaves the smallest id of each
group, secrets are masked, the mix takes each source's documents as often as its
target asks, and the mix is packed into sequences. Every stage but the last
returns the columns of documents. Nulls, empty texts, repeated rows, empty
tables and further columns are handled as the operators' own texts say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studylake.llm import minhash, mixing, packing, quality_rules, secrets
from studylake.llm.common import read_table, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules accept."""
    return quality_rules.keep(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return minhash.keep(docs, width=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked."""
    return secrets.clean(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The stages rest on a fitted model, hashing and dynamic programming, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
