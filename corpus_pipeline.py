"""A corpus from documents to packed sequences: five stages, each on what the last one kept.

Each stage takes (spark, docs, sf_dir) with ``docs`` read from Parquet, and returns what the
next one gets; ``run`` stores every stage in the shared scratch folder and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sazonal.llm import bin_completion, exact_dedup, lsh_forest, neighbour_quality, pivotal_mix
from sazonal.llm.common import ARROW_BYTES, ship, stored, table
from sazonal.llm.queries import TOKENIZER


#: Executors hold what five stages leave behind, so batches are half as large as elsewhere.
BATCH_BYTES = ARROW_BYTES // 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes do not reject."""
    ship(spark, BATCH_BYTES)
    labels = neighbour_quality.training_rows(table(spark, sf_dir, "labels"))
    model = neighbour_quality.fit_quality(docs, labels)
    return neighbour_quality.score_quality(docs, model).where("quality_score >= 0.5").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs).documents


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark, BATCH_BYTES)
    return lsh_forest.first_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark, BATCH_BYTES)
    return pivotal_mix.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences."""
    ship(spark, BATCH_BYTES)
    path = public_tokenizers.path(TOKENIZER)
    return bin_completion.pack(docs, path).drop("row_id")


STAGES = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack),
]

#: Votes of neighbours and seeded rounding are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
