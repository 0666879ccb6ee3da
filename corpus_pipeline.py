"""From raw documents to packed training sequences: quality rules, near-dedup, substring dedup, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import packing, quality, secrets, simhash, suffixes
from foliospark.llm.common import cut, table


def host_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host isn't rejected."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of SimHash near-duplicates."""
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that occur earlier."""
    return suffixes.strip(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by their kind."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("host_quality", host_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_redaction", secret_redaction),
    ("pack_sequences", pack_sequences),
]
#: Near-dedup, substring dedup and tokens have no SQL; tests hold the result against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
