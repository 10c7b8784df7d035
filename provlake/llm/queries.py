"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm import leaked_items, look_alike, near_duplicates, packing, residue, text_quality
from provlake.session import load


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return look_alike.look_alike_pairs(load(spark, d, "captures"), "capture_id", "extracted_txt")


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return look_alike.look_alike_classes(load(spark, d, "captures"), "capture_id", "extracted_txt")


def p3_consistent_text(spark: SparkSession, d: str) -> DataFrame:
    return look_alike.consistent_text(load(spark, d, "captures"), "capture_id", "extracted_txt")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_pairs(load(spark, d, "captures"), "capture_id", "extracted_txt")


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(load(spark, d, "captures"), "capture_id", "extracted_txt")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items.leaked_items(load(spark, d, "documents"), "doc_id", "text", load(spark, d, "eval_item"), "item_id", "text")


def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items.leaked_passages(load(spark, d, "documents"), "doc_id", "text", load(spark, d, "eval_item"), "item_id", "text")


def _residue(f, spark: SparkSession, d: str) -> DataFrame:
    return f(load(spark, d, "captures"), load(spark, d, "manifest"), "capture_id", "extracted_txt", "capture_dir")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _residue(residue.residue_scores, spark, d).where("is_residue").select("capture_id")


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """The captures without the cases, with all their columns."""
    return load(spark, d, "captures").join(p1_found(spark, d), "capture_id", "left_anti")


def p1_validation(spark: SparkSession, d: str) -> DataFrame:
    return _residue(residue.validation, spark, d)


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(load(spark, d, "documents"), load(spark, d, "pack_size"), "doc_id", "text")


def p6_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p6_pack(spark, d), load(spark, d, "pack_size"))


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    return text_quality.quality_statistics(load(spark, d, "documents"), load(spark, d, "doc_label"), load(spark, d, "common_word"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_statistics(spark, d).where("form <> 'prose'").select("doc_id", F.col("form").alias("kind"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_clean, p1_validation, p3_found, p3_classes, p3_consistent_text, p4_found, p4_groups, p6_pack, p6_usage, p7_found, p7_passages, p8_found, p8_statistics)}


def oracle_sql() -> dict[str, str]:
    return {}
