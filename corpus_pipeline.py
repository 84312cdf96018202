"""The training-data pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage works on all that its predecessor kept. Stages take and return the
columns of ``documents``; the last returns the packed pieces. Between stages
the rows are written as Parquet and read again.

All stages decide on rows. Rows that repeat a doc_id, a text or both are
documents of their own until a stage drops one of them; further columns, under
any names, are passed through up to the packing; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.llm import minhash, mixing, packing, pii, quality
from relcast.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the base rule accept. Null and empty texts have no words and go; null ids and repeated rows are judged like others."""
    return quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id, on shingles of five words.

    Of rows that repeat this id the first read stays. Rows with a null id, a
    null text or a text without words belong to no group and stay.
    """
    return minhash.keep_documents(docs, size=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; n_chars follows the new text. Null texts stay null, with a null n_chars; empty ones stay empty."""
    return pii.redact_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, 0 to 2 times, each row drawn by itself. Null sources are one source; texts without words have size 0 and are drawn like others."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins: one row per piece, also for each copy of a document. A document without words has one empty piece and no bin."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages (compression, pivotal rounding, packing).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
