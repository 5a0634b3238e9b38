

import pyarrow.parquet as pq
import pytest

#: Columns whose names the operators use inside.
CLASHING = ("key", "digest", "uid", "n", "length", "rank", "first", "class_id", "kept", "size", "sha256", "label", "members")



@pytest.fixture(scope="session")
def documents():
    return pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def labels():
    return pq.read_table("/root/testdata/sf0.001/labels.parquet").to_pylist()


@pytest.fixture(scope="session")
def messy(spark):
    """(rows, DataFrame): nulls, empty, very long and repeated texts, repeated rows, a null id, and clashing columns."""
    body = " ".join(f"w{k % 97}x{k}" for k in range(120))
    rows = [
        (1, body), (2, body), (2, body), (3, None), (4, ""), (5, " \t\n "), (6, "a"), (7, "a"), (8, "one two three four"),
        (9, body + " tail"), (None, body), (None, None), (10, "same " * 300), (11, "x" * 100_000), (12, " ".join(f"l{k}" for k in range(30_000))),
        (13, body.replace("w5x5", "changed")), (14, "é  \x1c ß " + body[:200]), (2**62, "big id"), (-3, "negative id"), (15, "A\nA\nA\nb b b b\n\n"),
    ]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return rows, spark.createDataFrame([(*r, *["?"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
