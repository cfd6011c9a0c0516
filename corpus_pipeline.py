"""From raw documents to packed training sequences, as five stages.

Each stage reads what its predecessor kept, as written Parquet. All but the last give
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmfold.llm import jaccard, language, mixing, packing, quality
from firmfold.llm.common import configure, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule of the threshold table."""
    configure(spark)
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the model learns from the stage's own labelled input."""
    configure(spark)
    return language.keep_known(docs, language.train(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    configure(spark)
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of the mix: a row per document and pass that took words of it."""
    configure(spark)
    return mixing.mixed_texts(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# A trained classifier and token ids are beyond SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
