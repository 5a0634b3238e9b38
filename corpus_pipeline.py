"""The corpus pipeline: quality filter, exact and near deduplication, mixing, packing.

Every stage takes what its predecessor kept, as a table read from Parquet, and all but the last return the columns of
``documents``. A stage removes rows; it never changes one. Rows with null ids or texts, repeated rows and empty tables are
treated as the stage's operator defines. A row is known by its id and its text's SHA-256: rows of one id are decided each,
rows alike in both together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.classifier import fit_quality, keep_good
from lodestone.llm.common import stored, table, text_uid, unused
from lodestone.llm.exact_dedup import drop_exact_copies
from lodestone.llm.mixing import mix
from lodestone.llm.near_dedup import near_duplicates
from lodestone.llm.packing import best_fit_packing


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, uid) isn't in ``gone``. Merged, at every size: these grow with the corpus."""
    at, uid = unused(docs.columns, "id", "uid")
    keys = gone.select(F.col("doc_id").alias("gone_id"), F.col("uid").alias("gone_uid")).distinct()
    rows = docs.withColumn(at, F.col("doc_id").cast("long")).withColumn(uid, text_uid(F.col("text")))
    return rows.join(keys.hint("merge"), rows[at].eqNullSafe(keys["gone_id"]) & (rows[uid] == keys["gone_uid"]), "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: rows whose text the classifier rejects go. Fitted on the labelled ones of the input."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of equal texts the row with the largest doc_id stays."""
    return drop_exact_copies(docs).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each class of near duplicates the document with the smallest doc_id stays."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents are drawn at their fitted rates, once at most."""
    return _without(docs, mix(docs, table(spark, sf_dir, "labels"), bound=1.0).where("not kept"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces and their places in sequences of 4096 tokens."""
    return best_fit_packing(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("mixing", mixture),
    ("best_fit_packing", packing),
]

#: The classifiers and the packing search can't be put in SQL. Tests hold the stages against brute force (exact and near
#: copies), held-out labels, targets and exact packings, and run() against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
