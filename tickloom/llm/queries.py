"""Registered queries of the operators over the given tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bins, centroids, chat, chunks, hamming, language, lines, packing, pieces, quality, repair, secret_scan, simhash
from tickloom.llm.sql import SQL
from tickloom.llm.tables import table


def op1_chat_preferences(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_query(table(spark, folder, "conversations"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.duplicate_lines(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_query(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_query(table(spark, folder, "documents"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.pieces_query(table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets_query(table(spark, folder, "documents"))


def op9_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.chunks_query(table(spark, folder, "documents"))


def op10_hamming_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return hamming.top_k(table(spark, folder, "embeddings"))


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return bins.bins_query(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_query(table(spark, folder, "conversations"))


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters_query(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_preferences,
        op2_quality_rules,
        op3_line_dedup,
        op4_packing,
        op5_simhash,
        op6_language,
        op7_sentencepiece,
        op8_secret_scan,
        op9_chunk_dedup,
        op10_hamming_top_k,
        op11_best_fit_packing,
        op12_conversation_repair,
        op13_centroid_clusters,
    )
}
