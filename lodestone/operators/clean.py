"""Boilerplate: lines that many documents of one host share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions.columns import strip
from ..tables import stored


def boilerplate_lines(docs: DataFrame, min_docs: int = DEFAULTS.boilerplate_min_docs, min_share: float = DEFAULTS.boilerplate_min_share, longest: int = DEFAULTS.boilerplate_max_line) -> DataFrame:
    """(host, line, n): stripped lines in at least ``min_docs`` and ``min_share`` of a host's documents.

    A line counts once for each document: its lines are made distinct within the row, so counting needs one shuffle,
    with partial sums before it. Rows are documents with (id, host, text).
    """
    lines = F.array_distinct(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), strip))
    found = docs.select("host", F.explode(lines).alias("line")).where((F.length("line") > 0) & (F.length("line") < longest))
    counted = found.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    sizes = docs.groupBy("host").agg(F.count("*").alias("docs"))
    return counted.join(sizes, "host").where(F.col("n") >= min_share * F.col("docs")).select("host", "line", "n")


def clean_docs(docs: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Documents without their host's boilerplate lines; those left empty go. Blank lines stay.

    A host's lines are one array: a line must be in ``min_share`` of the documents, each of bounded length, so there
    are few of them however many documents the host has. The table is written first: Spark then knows its size and
    broadcasts it if it is small, and can split a host with most of the documents if it isn't.
    """
    per_host = stored((boilerplate_lines(docs) if lines is None else lines).groupBy("host").agg(F.collect_set("line").alias("_gone")), "boilerplate")
    joined = docs.join(per_host, "host", "left")
    kept = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: ~F.array_contains(F.col("_gone"), strip(x)))
    text = F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", strip(text)).where("text <> ''").select(docs.columns)
