import hashlib
import os
from collections import defaultdict

from pyspark.sql import functions as F

from lodestone.llm.exact_dedup import drop_exact_copies, exact_dedup, grace_groups
from lodestone.llm.queries import op9_exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    top = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    return sorted(((i, top[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)


def check(found, rows):
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_messy(spark, messy):
    check(exact_dedup(messy[1]), messy[0])


def test_spilling_gives_the_same(messy):
    check(exact_dedup(messy[1].repartition(3), table_bytes=400), messy[0])


def test_documents(spark, sf_dir, documents):
    check(op9_exact_dedup(spark, sf_dir), [(d["doc_id"], d["text"]) for d in documents])


def test_empty(nothing):
    assert exact_dedup(nothing).count() == 0
    assert drop_exact_copies(nothing).columns == nothing.columns


def test_rows_that_stay(messy):
    left = drop_exact_copies(messy[1])
    assert left.columns == messy[1].columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(t or "" for _, t in got) == sorted({t or "" for _, t in messy[0]})
    assert (2, messy[0][1][1]) in got and (7, "a") in got


def test_grace_recursion_and_scratch(tmp_path):
    records = [(os.urandom(50) if k % 3 else b"hot" * 20, (k,)) for k in range(3000)]
    groups = list(grace_groups(iter(records), "q", table_bytes=3000, scratch=str(tmp_path)))
    assert sum(len(m) for _, m in groups) == 3000
    assert len({c for c, _ in groups}) == len(groups) == 2001
    assert max(len(m) for _, m in groups) == 1000
    assert not list(tmp_path.iterdir())


def test_copies_have_the_same_hash_path_at_every_level():
    same = [(b"x" * 1000, (k,)) for k in range(500)] + [(b"y" * 1000, (k,)) for k in range(500)]
    assert sorted(len(m) for _, m in grace_groups(iter(same), "q", table_bytes=10)) == [500, 500]


def test_texts_of_equal_short_hashes_stay_apart(spark):
    texts = spark.range(200_000).selectExpr("cast(id as string) as text")
    x, y = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").first()["t"][:2]
    docs = spark.createDataFrame([(None, x), (None, y), (None, x), (1, x), (1, y), (2, x)], "doc_id long, text string")
    assert sorted(map(tuple, drop_exact_copies(docs).collect())) == sorted([(2, x), (1, y)])
    nameless = docs.where("doc_id is null")
    assert sorted(r.text for r in drop_exact_copies(nameless).collect()) == sorted([x, y])


def test_dropping_takes_any_column_names_and_keeps_one_of_repeated_rows(spark):
    schema = "doc_id long, text string, `_id` string, id string, uid string, again string, `one` string, gone_id string, gone_uid string, kept string, keep_id string, key string"
    rows = [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (3, "c"), (3, "c"), (4, "c"), (None, "d"), (None, "d"), (None, "e"), (None, "a"), (5, None), (6, "")]
    found = drop_exact_copies(spark.createDataFrame([(*r, *["?"] * 10) for r in rows], schema))
    assert found.columns == spark.createDataFrame([], schema).columns
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted([(2, "a"), (3, "b"), (4, "c"), (None, "d"), (None, "e"), (6, "")], key=repr)
