"""The functions that Catalyst has no expression for, by name in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import text as T
from .chunks import register_chunker


def register_functions(spark: SparkSession) -> None:
    """normalize_text(text), lcs_len(array, array), decode_html(body, content_type) and the table function chunk_document."""
    spark.udf.register("normalize_text", T._normalized)
    spark.udf.register("lcs_len", T.lcs_len)
    spark.udf.register("decode_html", T.decode_html)
    register_chunker(spark)
