"""The corpus pipeline: junk out, near-duplicates out, sources mixed, windows packed.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freightloom.llm import mixing, packing, quality, simhash
from freightloom.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from ``labels``."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id."""
    return simhash.keep_one(docs)


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture reads it: at least once, and no source over twice as often as another."""
    return mixing.mixed(docs).select(docs.columns)


def lexical_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents (a repeated one has pieces for each reading) in windows."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("temperature_mixing", temperature_mixing),
    ("lexical_packing", lexical_packing),
]

#: Learned scores, XXH64 bits, hashes and tokenizers are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
