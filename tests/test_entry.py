import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def told(rows, names):
    def plain(v):
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return repr(v)
        return repr(float(v)) if not (isinstance(v, float) and math.isnan(v)) else "None"

    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted([plain(r[k]) for k in order] for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    expected = duck.sql(entry.oracle_sql()[name])
    assert told([tuple(r) for r in found.collect()], found.columns) == told(expected.fetchall(), expected.columns)


def test_oracles_are_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["chunk_windows", "hybrid_answers"])
def test_the_others_run(spark, name):
    assert entry.queries()[name](spark, SF).collect()
