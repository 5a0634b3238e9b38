import re
from collections import Counter

import pytest
from conftest_words import words_of

from lodestone.llm.queries import op4_quality_rules
from lodestone.llm.quality_rules import THRESHOLDS, Threshold, quality_rules


def brute(text):
    text = text or ""
    words = words_of(text)
    n = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {j for k in range(len(words) - 2) if n[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if words_of(x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(found, rows):
    got = sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_messy(messy):
    check(quality_rules(messy[1]), messy[0])


def test_documents(spark, sf_dir, documents):
    check(op4_quality_rules(spark, sf_dir), [(d["doc_id"], d["text"]) for d in documents])


def test_empty(nothing):
    assert quality_rules(nothing).count() == 0


def test_base_failures_are_never_kept_and_clean_documents_are(spark, sf_dir, labels):
    quality = {r["doc_id"]: r["quality"] for r in labels}
    rows = op4_quality_rules(spark, sf_dir).collect()
    assert not [r for r in rows if r.base_failed and r.kept]
    good = [r.kept for r in rows if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if quality.get(r.doc_id) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_thresholds_are_a_table(spark):
    docs = spark.createDataFrame([(1, "the cat " * 40)], "doc_id long, text string")
    only = quality_rules(docs, (Threshold("symbols", "symbol_ratio", None, 0.1),)).first()
    assert only.failed_rules == [] and only.base_failed
    assert "repeated_words" in quality_rules(docs, THRESHOLDS).first().failed_rules


def test_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    plan = op4_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("text, covered", [("a b c a b c", 6), ("a a a a", 4), ("a b c d", 0), ("x a b c y a b c z", 6), ("a a a", 0)])
def test_repeated_words(spark, text, covered):
    assert quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_repeat_words == covered
