"""Scans. Files have no order in Spark, so whatever depends on it takes ``seq``, the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import netloc


def queries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("id", "query")


def links(spark: SparkSession, path: str) -> DataFrame:
    """A missing file is an error, raised here and not at the first action."""
    return spark.read.parquet(path).select("id", "url")


def first_per_key(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key, one of equals. Rows with a null key are one key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def docs_jsonl(spark: SparkSession, path: str, first_wins: bool = True) -> DataFrame:
    """Documents of JSON lines; lines that can't be read are skipped, such as a last one still being written.

    ``seq`` is taken from the data where it has one, else from the place in the files. Of an id's records the first stays.
    """
    raw = (
        spark.read.schema(f"{schemas.DOCS}, _bad string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    )
    rows = raw.where("_bad IS NULL AND id IS NOT NULL")
    order = [F.col("seq").asc_nulls_last(), "_file", "_block", "_row"]
    kept = first_per_key(rows, ["id"], order) if first_wins else rows
    return kept.drop("_bad", "_file", "_block", "_row")


def chunks_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of JSON lines; a line that can't be read is an error."""
    return spark.read.schema(schemas.CHUNKS).option("mode", "FAILFAST").json(path)


def answers_json(spark: SparkSession, path: str, gold: bool = False) -> DataFrame:
    """Submission or gold records of a JSON array."""
    return spark.read.schema(schemas.GOLD if gold else schemas.ANSWERS).option("multiLine", True).json(path)


def doc_metadata(docs: DataFrame) -> DataFrame:
    """id, url, title, lang and host; of an id's records the first."""
    kept = first_per_key(docs, ["id"], [F.col("seq").asc_nulls_last()])
    return kept.select("id", "url", "title", "lang", netloc(F.col("url")).alias("host"))


def clusters(spark: SparkSession, path: str | None) -> DataFrame:
    """(doc_id, cluster_id), empty without a path."""
    return spark.read.parquet(path).select("doc_id", "cluster_id") if path else spark.createDataFrame([], schemas.CLUSTERS)


def last_status(log: DataFrame) -> DataFrame:
    """The last status of every id; partial maxima before the shuffle."""
    return log.groupBy("id").agg(F.max_by("status", "seq").alias("status"))


def docs_by_id(docs: DataFrame, ids: list[int]) -> DataFrame:
    """Point lookups; the ids reach the Parquet scan as a pushed filter."""
    return docs.where(F.col("id").isin(*ids))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and sizes, without contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def vectors_in_order(vectors: DataFrame, wanted: DataFrame) -> DataFrame:
    """The vectors of ``wanted`` (position, chunk_id) with their positions; a missing one makes the query fail."""
    found = wanted.join(vectors, "chunk_id", "left")
    checked = F.when(F.col("embedding").isNull(), F.raise_error(F.concat(F.lit("no vector for "), "chunk_id"))).otherwise(F.col("embedding"))
    return found.withColumn("embedding", checked)


def index_mismatch(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks without vector and vectors without chunk; empty if the index is whole."""
    a, b = chunks.select("chunk_id"), vectors.select("chunk_id")
    return a.join(b, "chunk_id", "left_anti").withColumn("missing", F.lit("vector")).unionByName(b.join(a, "chunk_id", "left_anti").withColumn("missing", F.lit("chunk")))
