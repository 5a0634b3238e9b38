"""Exact vector search and an embedding that needs no model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.columns import BROADCAST_ROWS

#: Queries of one block: a task holds one block's matrix, and the corpus is read once for each block.
BLOCK = 4096


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """With the norms' guard of 1e-9, so a zero vector is like nothing."""
    return dot(a, b) / ((norm(a) + 1e-9) * (norm(b) + 1e-9))


def search_vectors(queries: DataFrame, vectors: DataFrame, k: int, langs: list[str] | None = None, key: str = "chunk_id", by: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, <by>, <key>, score, rank): the k vectors of largest inner product for each query.

    The language filter reaches the scan. Queries (query_id, embedding) are taken in blocks, one matrix each; every task
    multiplies its vectors with the block and passes on its own k best of each query, so the shuffle carries k rows a
    query and task, and the final rank is taken among those.
    """
    rows = vectors.where(F.col("lang").isin(*langs)) if langs else vectors
    block: list = []
    parts: list[DataFrame] = []
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*by, key).dtypes)
    for row in queries.select("query_id", "embedding").toLocalIterator():
        block.append(row)
        if len(block) == BLOCK:
            parts.append(_best_of_tasks(rows, block, k, key, by, schema))
            block = []
    if block or not parts:
        parts.append(_best_of_tasks(rows, block, k, key, by, schema))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    place = F.row_number().over(Window.partitionBy("query_id", *by).orderBy(F.desc(F.round("score", 6)), key))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _best_of_tasks(rows: DataFrame, block: list, k: int, key: str, by: tuple[str, ...], schema: str) -> DataFrame:
    size = len(block[0]["embedding"]) if block else 0
    queries = np.array([r["query_id"] for r in block], np.int64), np.array([r["embedding"] for r in block], np.float64).reshape(len(block), size)
    shared = rows.sparkSession.sparkContext.broadcast(queries)  # at most ``BLOCK`` vectors

    def best_of(part: pd.DataFrame, ids: np.ndarray, matrix: np.ndarray) -> pd.DataFrame:
        score = np.stack(part["embedding"].to_numpy()).astype(np.float64) @ matrix.T
        coarse = -score.round(6)
        # All that are no worse than the k-th, ties too.
        row, query = np.nonzero(coarse <= np.partition(coarse, k - 1, axis=0)[k - 1]) if k < len(part) else np.indices(score.shape).reshape(2, -1)
        made = part[[*by, key]].iloc[row].reset_index(drop=True)
        made["query_id"], made["score"], made["_r"] = ids[query], score[row, query], coarse[row, query]
        return made

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        best = None
        for frame in frames:
            if not len(ids) or not len(frame):
                continue
            for low in range(0, len(frame), 2048):
                part = frame.iloc[low : low + 2048]
                groups = [g for _, g in part.groupby([*by], sort=False)] if by else [part]
                best = pd.concat([*([] if best is None else [best]), *(best_of(g, ids, matrix) for g in groups)], ignore_index=True)
                best = best.sort_values(["_r", key], kind="stable").groupby(["query_id", *by], sort=False).head(k)
        if best is not None:
            yield best.drop(columns="_r")

    return rows.select(*by, key, "embedding").mapInPandas(run, f"{schema}, query_id long, score double")


def pairs_within(queries: DataFrame, vectors: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """(query_id, chunk_id, score) of a query set of checked size against all vectors, in the JVM; for short lists."""
    if queries.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} queries")
    asked = queries.select("query_id", F.col("embedding").alias("q"))
    return vectors.join(F.broadcast(asked), F.lit(True)).select("query_id", "chunk_id", dot(F.col("q"), F.col("embedding")).alias("score"))


class HashedEmbedder:
    """Stands in for a model: a signed bag of hashed tokens, of length 1. Same for queries and documents but a prefix."""

    def __init__(self, size: int = 256, query_prefix: str = ""):
        self.size, self.query_prefix = size, query_prefix

    def _of(self, text: Column) -> Column:
        size = self.size

        @F.arrow_udf("array<float>")
        def summed(hashes: pa.Array) -> pa.Array:
            sizes, h = pc.list_value_length(hashes).fill_null(0).to_numpy(), hashes.flatten().to_numpy()
            place = np.repeat(np.arange(len(sizes)) * size, sizes) + h % size
            v = np.bincount(place, np.where(h < 0, -1.0, 1.0), len(sizes) * size).reshape(-1, size)
            v = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * size), pa.array(v.ravel()))

        return summed(F.transform(T.lexical_tokens(T.normalized(F.coalesce(text, F.lit("")))), lambda t: F.xxhash64(t)))

    def encode_docs(self, rows: DataFrame, text: str = "text") -> DataFrame:
        return rows.withColumn("embedding", self._of(F.col(text)))

    def encode_queries(self, rows: DataFrame, text: str = "text") -> DataFrame:
        return rows.withColumn("embedding", self._of(F.concat(F.lit(self.query_prefix), F.col(text))))


class ModelEmbedder:
    """Vectors of a model: ``load()`` is called once in each worker and returns texts -> matrix."""

    def __init__(self, load, query_prefix: str = ""):
        self.load, self.query_prefix = load, query_prefix

    def encode_docs(self, rows: DataFrame, text: str = "text") -> DataFrame:
        return encode_with(rows, self.load, text)

    def encode_queries(self, rows: DataFrame, text: str = "text") -> DataFrame:
        return encode_with(rows.withColumn("_asked", F.concat(F.lit(self.query_prefix), F.col(text))), self.load, "_asked").drop("_asked")


def encode_with(rows: DataFrame, load, text: str = "text", batch: int = 64) -> DataFrame:
    """Embeddings from a model: ``load()`` is called once in each worker and returns texts -> matrix; rows are normalised."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for some in batches:
            parts = [np.asarray(model(some.iloc[k : k + batch].fillna("").tolist()), np.float32) for k in range(0, len(some), batch)]
            whole = np.concatenate(parts) if parts else np.zeros((0, 1), np.float32)
            yield pd.Series(list(whole / np.maximum(np.linalg.norm(whole, axis=1, keepdims=True), 1e-12)))

    return rows.withColumn("embedding", encode(F.col(text)))
