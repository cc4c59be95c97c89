"""The corpus pipeline: quality, near duplicates, contamination, secrets, mix; each stage's Parquet feeds the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm.common import shared_folder, table
from wordmill.llm.decontaminate import drop_contaminated
from wordmill.llm.mixing import mixed_documents
from wordmill.llm.quality import keep_good
from wordmill.llm.secrets import redact_secrets
from wordmill.llm.simhash import simhash_dedup


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier keeps."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 2 bits)."""
    return simhash_dedup(docs, k=3, radius=2, seed=42)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the contaminated ones."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets masked."""
    return redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents, their epoch and the words taken."""
    return mixed_documents(docs, weights=(5, 2, 1), share=1.5, most=2.0, seed=42)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]

# The first stage is a trained model, which SQL cannot express; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    folder, docs = shared_folder(spark, "pipeline"), table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
