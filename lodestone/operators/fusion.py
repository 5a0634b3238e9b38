"""Fusion of ranked lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS


def rrf(lists: DataFrame, by: tuple[str, ...] = ("query_id",), k: int = DEFAULTS.rrf_k, weights: Mapping[str, float] | Column | None = None, key: str = "chunk_id") -> DataFrame:
    """(<by>, <key>, score, rank) of rows (<by>, list_name, <key>, rank): the sum of weight / (k + rank).

    A rank counts the distinct ids so far: a repeat neither scores nor takes a rank. Weight 1 where none is given. Equal
    scores by id.
    """
    once = lists.groupBy(*by, "list_name", key).agg(F.min("rank").alias("_at"))
    placed = once.withColumn("_rank", F.row_number().over(Window.partitionBy(*by, "list_name").orderBy("_at", key)))
    if isinstance(weights, Mapping):
        weight: Column = F.lit(1.0)
        for name, w in weights.items():
            weight = F.when(F.col("list_name") == name, float(w)).otherwise(weight)
    else:
        weight = F.lit(1.0) if weights is None else weights
    fused = placed.groupBy(*by, key).agg(F.sum(weight / (k + F.col("_rank"))).alias("score"))
    return fused.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(F.round("score", 9)), key)))


def truncated(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.where(F.col("rank") <= n)


def original_doubled(list_name: Column) -> Column:
    """Lists of the original query weigh twice what others do."""
    return F.when(list_name.endswith(":orig"), 2.0).otherwise(1.0)


def gated(lists: DataFrame, mode: str) -> DataFrame:
    """The lists that a mode has: bm25, dense or, as hybrid, both."""
    return lists if mode == "hybrid" else lists.where(F.col("list_name").startswith(f"{mode}:"))


def pooled(lists: DataFrame, depth: int = DEFAULTS.pool_depth, docs: int = DEFAULTS.pool_docs, per_doc: int = DEFAULTS.chunk_max_per_doc, k: int = DEFAULTS.rrf_k) -> DataFrame:
    """Documents to label, with their passages, from rows (query_id, mode, doc_id, chunk_id, rank).

    A passage scores the sum of 1 / (k + rank); a document that of its best rank in each mode. Returns query_id, doc_id,
    doc_score, doc_rank, modes, chunk_id, chunk_score, chunk_rank.
    """
    rows = lists.where(F.col("rank") <= depth)
    best = rows.groupBy("query_id", "mode", "doc_id").agg(F.min("rank").alias("best"))
    scored = best.groupBy("query_id", "doc_id").agg(F.sum(1 / (k + F.col("best"))).alias("doc_score"), F.sort_array(F.collect_set("mode")).alias("modes"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("doc_score", 9)), "doc_id"))
    chosen = scored.withColumn("doc_rank", place).where(F.col("doc_rank") <= docs)
    chunks = rows.groupBy("query_id", "doc_id", "chunk_id").agg(F.sum(1 / (k + F.col("rank"))).alias("chunk_score"))
    inner = F.row_number().over(Window.partitionBy("query_id", "doc_id").orderBy(F.desc(F.round("chunk_score", 9)), "chunk_id"))
    return chunks.withColumn("chunk_rank", inner).where(F.col("chunk_rank") <= per_doc).join(chosen, ["query_id", "doc_id"])
