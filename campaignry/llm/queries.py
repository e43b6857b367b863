"""Registered queries of the corpus operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignry.llm import align, counting, exact, jaccard, kmeans, licenses, mixing, pieces, quality, secrets, sharding, warc, windows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(table(spark, folder, "pages"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, folder, "documents"))


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded_documents(table(spark, folder, "documents"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_scan(table(spark, folder, "documents"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return counting.counted_after_edits(docs, counting.sample_edits(docs["text"]))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.aligned_documents(table(spark, folder, "documents"))


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = windows.cut_documents(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.clustered(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_warc, op2_mixing, op3_sharding, op4_jaccard_join, op5_exact_dedup, op6_pieces, op7_secret_scan, op8_license_scan,
           op9_token_counts, op10_quality_rules, op11_alignment, op12_substring_dedup, op13_centroids, pipeline]
    return {op.__name__: op for op in ops}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.ORACLE, "op2_mixing": mixing.ORACLE, "op5_exact_dedup": exact.ORACLE,
            "op7_secret_scan": secrets.ORACLE, "op8_license_scan": licenses.oracle(),
            "op12_substring_dedup": windows.ORACLE, "op13_centroids": kmeans.oracle()}
