"""The offline build: pages to documents, clean documents, clusters, chunks and indexes, each a table under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chunks import chunk_documents
from ..functions.text import embed_text
from ..operators import crawl, dedup, lexical
from ..operators.clean import clean_docs
from ..sources import readers
from ..sources.writers import overwrite, save_clusters, save_vectors


def with_hosts(docs: DataFrame) -> DataFrame:
    return crawl.with_host(docs)


def build_documents(pages: DataFrame, path: str, structured: bool = True) -> DataFrame:
    """Documents of (id, url, status, html) pages that are ok, with a sequence by id."""
    found = crawl.extract_pages(pages, structured).where("status = 'ok'").drop("status")
    return overwrite(found.withColumn("seq", F.col("id")), path)


def build_clusters(docs: DataFrame, path: str) -> DataFrame:
    clean = clean_docs(with_hosts(docs)).select(F.col("id").alias("doc_id"), "text")
    return save_clusters(dedup.build_clusters(clean)[0], path)


def build_chunks(docs: DataFrame, path: str) -> DataFrame:
    return overwrite(chunk_documents(clean_docs(with_hosts(docs))), path)


def build_indexes(chunks: DataFrame, path: str, embedder=None) -> None:
    """The lexical index and, with an embedder, the vectors of context and text."""
    lexical.build_index(chunks, f"{path}/lexical")
    if embedder:
        texts = chunks.select("chunk_id", "doc_id", "lang", embed_text(F.col("context"), F.col("text")).alias("text"))
        save_vectors(embedder.encode_docs(texts), f"{path}/vectors")


def load_corpus(spark: SparkSession, path: str, with_vectors: bool = True):
    """The built tables; vectors that don't belong to the chunks are an error."""
    from .retrieval import Corpus

    read = lambda name: spark.read.parquet(f"{path}/{name}")
    vectors = read("vectors") if with_vectors else None
    if vectors is not None and not readers.index_mismatch(read("chunks"), vectors).isEmpty():
        raise ValueError("the vectors are not those of the chunks: build the indexes again")
    return Corpus(read("chunks"), readers.doc_metadata(read("docs")), read("clusters"), read("lexical/postings"), read("lexical/statistics"), vectors)
