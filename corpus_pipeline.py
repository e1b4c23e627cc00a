"""A corpus from raw documents to a training mix: five operators in turn, each on what the last one left.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heatwright.llm import decontaminate, mixing, near_dup, pii, quality_rules
from heatwright.llm.texts import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every identifier found replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: one row for each document piece in each slot of each output shard."""
    return mixing.mixed_blocks(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("personal data", redacted),
    ("mixing sources", mixed),
]

# Alignment, bootstrapping and hashed permutations are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs
