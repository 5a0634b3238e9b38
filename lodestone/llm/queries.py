"""The registered queries of this subpackage: each applies an operator with production parameters to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .automaton import substring_dedup
from .classifier import fit_quality, score_quality
from .common import table
from .exact_dedup import exact_dedup
from .mixing import mix
from .near_dedup import near_duplicates
from .oracles import ORACLES
from .packing import best_fit_packing
from .quality_rules import quality_rules
from .secret_scan import scan_versions, secret_digest
from .suffix_array import suffix_array_dedup
from .warc import read_records, write_archives


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = scan_versions(table(spark, sf_dir, "documents"))
    return secret_digest(findings)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = write_archives(table(spark, sf_dir, "pages"))
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("uid")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("uid")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc": op5_warc,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mixing": op8_mixing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_classifier": op10_quality_classifier,
}
