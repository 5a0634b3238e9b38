import hashlib
import random
import re

import numpy as np
import pytest
from conftest_words import words_of

from lodestone.llm.automaton import SuffixAutomaton, against_reference, compare_streamed, substring_dedup
from lodestone.llm.queries import op2_suffix_array_dedup, op7_substring_dedup
from lodestone.llm.repeats import remove_repeats, runs_of, sliding_argmin
from lodestone.llm.suffix_array import compare_sorted, suffix_array_dedup


def brute(rows, length):
    """Rows of one id are one place in the order; the earliest occurrence of a window stays."""
    first = {}
    for i, text in rows:
        words = words_of(text)
        for s in range(len(words) - length + 1) if i is not None else ():
            window = tuple(words[s : s + length])
            first[window] = min(first.get(window, (i, s)), (i, s))
    out = []
    for i, text in rows:
        words = words_of(text)
        gone = {
            j for s in range(len(words) - length + 1) if i is not None and first[tuple(words[s : s + length])] < (i, s) for j in range(s, s + length)
        }
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(found, rows, length):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()), key=repr)
    assert got == brute(rows, length)


OPERATORS = [pytest.param(substring_dedup, id="automaton"), pytest.param(suffix_array_dedup, id="suffix_array")]


@pytest.mark.parametrize("operator", OPERATORS)
@pytest.mark.parametrize("length", [20, 5])
def test_messy(messy, operator, length):
    check(operator(messy[1], length), messy[0], length)


@pytest.mark.parametrize("operator", OPERATORS)
def test_random_texts_of_few_words(spark, operator):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for k in range(40)]
    check(operator(spark.createDataFrame(rows, "doc_id long, text string"), 6), rows, 6)


@pytest.mark.parametrize("compare", [compare_streamed, compare_sorted])
def test_hot_anchors_are_compared_by_windows(spark, compare):
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(30)]
    rows = [(k, " ".join([f"l{rng.random()}" for _ in range(15)] + passage + [f"r{rng.random()}" for _ in range(15)])) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(remove_repeats(docs, 20, 8, compare, hot=3), rows, 20)


def test_documents(spark, sf_dir, documents):
    rows = [(d["doc_id"], d["text"]) for d in documents]
    check(op7_substring_dedup(spark, sf_dir), rows, 20)
    check(op2_suffix_array_dedup(spark, sf_dir), rows, 51)


def test_same_id_with_different_texts(spark):
    body = " ".join(f"w{k}" for k in range(40))
    rows = [(1, body), (2, body), (2, "other " * 30 + body), (2, body)]
    check(substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")), rows, 20)


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty(nothing, operator):
    assert operator(nothing).count() == 0


def test_kept_text_is_what_is_left(spark):
    body = " ".join(f"w{k}" for k in range(30))
    rows = substring_dedup(spark.createDataFrame([(1, body), (2, f"a  {body}\nb")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept_text for r in rows] == [body, "a b"] and rows[1].spans == "1:31"


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 15))] for _ in range(3)]
        query = [rng.choice("abcd") for _ in range(20)]
        automaton = SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        inside = lambda part: any(part == t[k : k + len(part)] for t in texts for k in range(len(t)))  # noqa: E731,B023
        for end, n in enumerate(automaton.statistics(query), 1):
            assert n == max(m for m in range(end + 1) if m == 0 or inside(query[end - m : end]))


def test_reference_spans(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    docs = spark.createDataFrame([(1, f"x y {passage} z"), (2, "nothing"), (3, None)], "doc_id long, text string")
    reference = spark.createDataFrame([(passage,), (None,)], "text string")
    assert [tuple(r) for r in against_reference(docs, reference).collect()] == [(1, 2, 27)]
    with pytest.raises(ValueError, match="bound"):
        against_reference(docs, reference, most_words=10)


def test_sliding_argmin_is_leftmost():
    rng = np.random.default_rng(0)
    for width in (1, 2, 3, 7, 13):
        values = rng.integers(0, 4, 50)
        expected = [s + int(np.argmin(values[s : s + width])) for s in range(50 - width + 1)]
        assert sliding_argmin(values, width).tolist() == expected
    assert len(sliding_argmin(np.arange(3), 4)) == 0


def test_runs():
    assert runs_of(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 1)] and runs_of(np.zeros(0, bool)) == []


def test_plan_shuffles_the_texts_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = op7_substring_dedup(spark, sf_dir)
        found.collect()
        assert re.search("ReusedExchange", found._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
