"""Sinks. Tables are committed by Spark's output protocol; single files are for what a person or a contest reads."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    rows.write.mode("append").format(fmt).save(path)


def overwrite(rows: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ()) -> DataFrame:
    rows.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)
    return rows.sparkSession.read.schema(rows.schema).format(fmt).load(path)


def replace_table(spark: SparkSession, new: str, path: str) -> str:
    """The table in ``new`` takes the place of the one in ``path``, which is moved beside it; returns where to.

    Two renames of folders: between them the table is in neither place, never half in one.
    """
    jvm, before = spark.sparkContext._jvm, f"{path}_before"
    at = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at(before), True)
    if not (fs.rename(at(path), at(before)) and fs.rename(at(new), at(path))):
        raise OSError(f"{new} can't be moved to {path}")
    return before


def raw_pages(pages: DataFrame, path: str) -> None:
    """(id, body): the fetched bytes, as a binary column."""
    pages.select("id", "body").write.mode("append").parquet(path)


def save_clusters(clusters: DataFrame, path: str) -> DataFrame:
    return overwrite(clusters.select("doc_id", "cluster_id"), path)


def save_vectors(vectors: DataFrame, path: str) -> DataFrame:
    """By language, so that a search of one language reads one folder."""
    return overwrite(vectors.select("chunk_id", "doc_id", "embedding", "lang"), path, by=("lang",))


def upsert_vectors(vectors: DataFrame, path: str) -> DataFrame:
    """Vectors, one for each chunk, added to the stored ones or in the place of those of the same chunks.

    The new table is written beside the old one and then takes its place, so a job that fails leaves the old one.
    """
    spark, new = vectors.sparkSession, vectors.select("chunk_id", "doc_id", "embedding", "lang")
    kept = spark.read.schema(new.schema).parquet(path).join(new.select("chunk_id"), "chunk_id", "left_anti")
    save_vectors(kept.unionByName(new), f"{path}_new")
    replace_table(spark, f"{path}_new", path)
    return spark.read.schema(new.schema).parquet(path)


def _records(rows: DataFrame):
    # Answers are at most a few passages for each query; they are fetched a partition at a time.
    return (json.loads(r[0]) for r in rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator())


def json_array(rows: DataFrame, path: str, order: str = "id", indent: int | None = None) -> int:
    """A JSON array ordered by ``order``, written beside ``path`` and then moved there; returns the number of records."""
    beside, n = Path(f"{path}.tmp"), 0
    beside.parent.mkdir(parents=True, exist_ok=True)
    with beside.open("w", encoding="utf-8") as out:
        out.write("[")
        for n, record in enumerate(_records(rows.orderBy(order)), 1):
            out.write(("," if n > 1 else "") + json.dumps(record, ensure_ascii=False, indent=indent))
        out.write("]")
    beside.replace(path)
    return n


def submission(answers: DataFrame, path: str) -> str:
    """The JSON file and, beside it, a zip with that file alone at its root."""
    json_array(answers, path)
    packed = str(Path(path).with_suffix(".zip"))
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        out.write(path, Path(path).name)
    return packed
