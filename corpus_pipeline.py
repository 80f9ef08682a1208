"""A corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept.  All but the last return the columns of documents; the last returns the
packed pieces.  Empty tables and nulls go through each stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylattice.llm import decontamination, near_dedup, packing, quality_classifier, storage, substring_dedup

#: Words of a repeated passage that is cut.
PASSAGE_WORDS = 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.distinct(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut out of the texts."""
    return substring_dedup.clean(docs, PASSAGE_WORDS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontamination.remove(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", pack),
]

#: No SQL for learning, fingerprints of hashes or tokenizers; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is a table in the shared folder, read again by the next stage."""
    folder = storage.work_dir(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = storage.save(docs, f"{folder}/{k}")
    return docs
