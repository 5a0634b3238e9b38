import pytest

import corpus_pipeline
from lodestone.llm.common import stored, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(spark, docs, SF), name)
        out.append((name, docs, found))
        docs = found
    return {name: (before, after) for name, before, after in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_rows_are_those_of_documents(stages, spark):
    whole = table(spark, SF, "documents")
    for name, (before, after) in stages.items():
        if name != "best_fit_packing":
            assert after.columns == whole.columns
            assert after.exceptAll(before).count() == 0 and after.count() > 0


def test_quality_keeps_good_and_rejects_bad(stages, spark):
    labels = table(spark, SF, "labels").collect()
    after = set(ids(stages["quality_classifier"][1]))
    good = [r["doc_id"] in after for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in after for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_exact_and_near_stages_against_brute_force(stages):
    from test_near_dedup import brute

    before, after = stages["exact_dedup"]
    top = {}
    for r in before.collect():
        top[r.text] = max(r.doc_id, top.get(r.text, r.doc_id))
    assert ids(after) == sorted(top.values())
    before, after = stages["minhash_near_dedup"]
    assert ids(after) == sorted(i for i, c in brute([(r.doc_id, r.text) for r in before.collect()]) if i == c)


def test_mixing_keeps_most_and_packing_takes_all(stages):
    before, after = stages["mixing"]
    assert after.count() >= 0.9 * before.count()
    before, packed = stages["best_fit_packing"]
    assert sorted({r.doc_id for r in packed.collect()}) == ids(before)


def test_run_is_the_stages_one_after_another(stages, spark):
    whole = corpus_pipeline.run(spark, SF)
    packed = stages["best_fit_packing"][1]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*names).collect())) == sorted(map(tuple, packed.select(*names).collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_messy_and_empty_tables(spark, messy, nothing, name, stage):
    found = stage(spark, messy[1], SF)
    assert found.count() > 0
    if name != "best_fit_packing":
        assert found.columns == messy[1].columns
    assert stage(spark, nothing, SF).count() == 0


def test_quality_is_decided_by_row_not_by_id(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    docs = table(spark, SF, "documents")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    good = next(rows[i] for i in sorted(labels) if labels[i] == 1 and i in kept and i in rows)
    bad = next(rows[i] for i in sorted(labels) if labels[i] == 0 and i not in kept and i in rows)
    extra = [r.asDict() | {"doc_id": i} for r in (good, bad) for i in (None, 2**40)]
    found = corpus_pipeline.quality(spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), SF)
    assert sorted((r.doc_id or 0, r.text) for r in found.where(f"doc_id is null or doc_id = {2**40}").collect()) == [(0, good.text), (2**40, good.text)]


def test_rows_of_one_id_go_or_stay_each(spark):
    near, far = " ".join(f"a{k}" for k in range(90)), " ".join(f"b{k}" for k in range(90))
    rows = [(1, near), (2, near + " tail"), (2, far), (None, near), (3, "x")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, uid string, gone_id int")
    assert sorted(((r.doc_id, r.text) for r in corpus_pipeline.near(spark, docs, SF).collect()), key=repr) == sorted([(1, near), (2, far), (None, near), (3, "x")], key=repr)
