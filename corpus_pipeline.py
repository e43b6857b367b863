"""Corpus pipeline: quality rules, exact dedup, near dedup, source mix, piece encoding; each stage over all it is given."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from campaignry.llm import exact, jaccard, mixing, pieces, quality
from campaignry.session import shared_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(pieces.numbered(docs))


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("piece_encoding", encode_pieces),
]

ORACLE_SQL = None  # the classifier and the piece encoder have no SQL form; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
