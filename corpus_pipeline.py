"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.llm._common import bucket_of, materialize
from stratocast.llm.decontamination import drop_contaminated
from stratocast.llm.language_id import RESULTS, identify_language, language_sample
from stratocast.llm.mixing import cycle_weight, mix_sources
from stratocast.llm.near_dedup import keep_one
from stratocast.llm.secrets import redact


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; learned from those that carry a label."""
    sample = language_sample(docs.where(bucket_of(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    own = {c: f"__own_{c}" for c in RESULTS if c in docs.columns}  # columns of documents that are named like the results stay as they are
    kept = identify_language(docs.withColumnsRenamed(own), sample).where(~F.col("rejected")).drop(*RESULTS)
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that look live replaced."""
    return redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``repeats``) and how many words (``taken``)."""
    return mix_sources(docs, cycle_weight()).where(F.col("taken") > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]

#: Compression and alignment have no counterpart in SQL; the stages are tested against plain versions instead (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
