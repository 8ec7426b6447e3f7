"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

The stages take and return the columns of ``documents``; the last returns the pieces of the packed sequences. A
document's id and place in a group decide ties, so a run on the same rows gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import neardup, quality, secrets, substrings
from parcelspark.llm.common import cols, stored
from parcelspark.llm.queries import pack_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the adaptive thresholds of their language and source; rejected ones go."""
    return quality.judged(quality.measured(docs)).where("kept").select(*cols(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id."""
    return neardup.deduplicated(docs)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages of 50 words and more that a document with a smaller id has too. A document may
    end up without words; it stays, so that no id is lost here."""
    return _counted(substrings.deduplicated(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by a placeholder."""
    return _counted(secrets.redacted(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences of at most 2048 ids."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# MinHash near-dedup is not expressible in SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents`` of ``sf_dir``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
