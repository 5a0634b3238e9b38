"""Small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side is broadcast; counted before it is.
BROADCAST_ROWS = 100_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row, as a lambda variable of ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end; ``trim`` knows only the space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def adjacent(items: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """``joined`` of each item and the next."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), n), F.slice(items, F.lit(2), n), joined)


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has ``rows`` rows at most, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
