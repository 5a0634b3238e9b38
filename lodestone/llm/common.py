"""What the operators of this subpackage share: table access, shared storage and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import fresh_path, shared_dir, stored

__all__ = ["WORD_GAP", "fresh_path", "let", "shared_dir", "slices", "stored", "table", "text_uid", "texts_of", "unused"]

#: Words are runs of anything but the six ASCII white-space characters; ``bytes.split()`` cuts at exactly these.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable.

    Catalyst may inline a projected expression into a higher-order function, where it would be evaluated again
    for every element; a lambda variable is bound once.
    """
    return F.transform(F.array(value), body).getItem(0)


def text_uid(text: Column) -> Column:
    """Half of a text's SHA-256, which with an id names a row; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, 32))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, changed until no column has them."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def texts_of(batch: pa.RecordBatch, column: str, rows: int = 256) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, texts) of slices of a batch; texts as UTF-8, null as empty. Slices bound what Python holds."""
    whole = batch.column(batch.schema.get_field_index(column))
    for at in range(0, batch.num_rows, rows):
        part = whole.slice(at, rows)
        yield at, [x or b"" for x in part.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of the string ``column``, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, end - at)
        at = end
