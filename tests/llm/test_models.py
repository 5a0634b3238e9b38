import math
import zlib

import numpy as np
import pytest
import xxhash

from lodestone.llm.classifier import fit_quality, score_quality
from lodestone.llm.common import table
from lodestone.llm.mixing import fit_rates, mix
from lodestone.llm.queries import op8_mixing, op10_quality_classifier
from lodestone.llm.textnet import Buckets, Net, shape

SF = "/root/testdata/sf0.01"


def area_under_curve(scores, truth):
    ranks = np.argsort(np.argsort(scores)) + 1.0
    n1, n0 = truth.sum(), (~truth).sum()
    return (ranks[truth].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.fixture(scope="module")
def quality_labels(spark):
    return {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}


def test_held_out_quality(spark, quality_labels):
    rows = op10_quality_classifier(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, quality_labels[r.doc_id] == 1) for r in rows if r.held_out and r.doc_id in quality_labels]
    scores, truth = np.array([s for s, _ in held]), np.array([t for _, t in held])
    assert area_under_curve(scores, truth) > 0.97
    assert (scores[truth] >= 0.3).mean() > 0.97 and (scores[~truth] < 0.3).mean() > 0.8
    # Calibrated: better than telling the share of good documents every time.
    share = truth.mean()
    assert -np.log(np.where(truth, scores, 1 - scores) + 1e-9).mean() < -(share * math.log(share) + (1 - share) * math.log(1 - share))


def test_held_out_labels_are_never_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality", "toxic")
    assert fit_quality(docs, labels) == fit_quality(docs, turned)


def test_messy_texts_are_scored(spark, messy, nothing):
    docs = table(spark, SF, "documents")
    model = fit_quality(docs, table(spark, SF, "labels"))
    rows = score_quality(messy[1], model).collect()
    assert len(rows) == len(messy[0]) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    assert score_quality(nothing, model).count() == 0


def test_without_labels_scores_are_constant(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = {r.score for r in score_quality(messy[1], fit_quality(messy[1], none)).collect()}
    assert len(scores) == 1
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 0), (2, 0, 0)], none.schema)
    assert score_quality(messy[1], fit_quality(messy[1], odd)).count() == len(messy[0])
    assert mix(messy[1], odd).count() == len(messy[0]) and mix(nothing, none).count() == 0


def test_mixing_meets_targets_and_keeps_clean_documents(spark):
    rows = op8_mixing(spark, SF).toPandas()
    weight = rows.n_tokens * rows.rate
    shares = [(weight * rows[f"p_{d}"]).sum() / weight.sum() for d in ("clean", "low", "toxic")]
    assert np.allclose(shares, [0.9, 0.05, 0.05], atol=0.005) and (rows.rate >= 0).all()
    assert np.allclose(rows[["p_clean", "p_low", "p_toxic"]].sum(axis=1), 1)
    # So do the copies drawn, of which rates above 1 may give two; and the whole query is the brute-force solution.
    drawn = rows.n_tokens * rows.copies
    assert np.allclose([(drawn * rows[f"p_{d}"]).sum() / drawn.sum() for d in ("clean", "low", "toxic")], [0.9, 0.05, 0.05], atol=0.01)
    assert ((rows.copies - rows.rate).abs() < 1).all() and (rows.kept == (rows.copies > 0)).all()
    p, tokens = rows[["p_clean", "p_low", "p_toxic"]].to_numpy(), rows.n_tokens.to_numpy(float)
    wanted = np.array([0.9, 0.05, 0.05]) * (tokens @ p)[0] / 0.9
    assert np.abs((brute_rates(p, tokens, wanted, True) * tokens) @ p - (rows.rate.to_numpy() * tokens) @ p).max() < 0.01 * wanted.sum()
    truth = table(spark, SF, "labels").toPandas().merge(rows, on="doc_id")
    clean = truth[(truth.quality == 1) & (truth.toxic == 0)]
    assert clean.kept.mean() > 0.97 and truth[truth.toxic == 1].rate.mean() < 0.8 * clean.rate.mean()


def brute_rates(p, tokens, wanted, protect, steps=20_000):
    """Plain projected gradient in the same metric."""
    rate, least = np.ones(len(tokens)), (p[:, 0] >= p.max(axis=1)) * (1.0 if protect else 0.0)
    top = np.linalg.eigvalsh((p * tokens[:, None]).T @ p)[-1]
    for _ in range(steps):
        rate = np.maximum(least, rate + p @ (wanted - (rate * tokens) @ p) / top)
    return rate


@pytest.mark.parametrize("targets", [{"clean": 0.6, "low": 0.3, "toxic": 0.1}, {"clean": 0.98, "low": 0.01, "toxic": 0.01}, {"clean": 1.0, "low": 0.0, "toxic": 0.0}])
@pytest.mark.parametrize("protect", [False, True])
def test_rates_are_the_least_squares_solution(spark, targets, protect):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([2, 0.5, 0.5], 300)
    tokens = rng.integers(1, 500, 300)
    members = spark.createDataFrame([(k, int(n), *map(float, q)) for k, (n, q) in enumerate(zip(tokens, p, strict=True))], "doc_id long, n_tokens long, p_clean double, p_low double, p_toxic double")
    rate, _ = fit_rates(members, targets, protect=protect, tolerance=1e-6)
    found = np.array([r[0] for r in members.select(rate).collect()])
    t = np.array(list(targets.values()))
    wanted = t * (tokens @ p)[0] / t[0]
    loss = lambda r: (((r * tokens) @ p - wanted) ** 2).sum() / wanted.sum() ** 2
    assert (found >= 0).all() and (not protect or (found[p[:, 0] >= p.max(axis=1)] >= 1).all()) and loss(found) <= loss(brute_rates(p, tokens.astype(float), wanted, protect)) + 2e-3


def test_bounded_rates_are_least_squares_that_a_draw_honours(spark):
    rng = np.random.default_rng(5)
    p = np.vstack([rng.dirichlet(a, n) for a, n in (([20, 0.2, 0.2], 1900), ([0.2, 20, 0.2], 30), ([0.2, 0.2, 20], 400))])
    tokens = rng.integers(50, 500, len(p))
    members = spark.createDataFrame([(k, int(n), *map(float, q)) for k, (n, q) in enumerate(zip(tokens, p, strict=True))], "doc_id long, n_tokens long, p_clean double, p_low double, p_toxic double")
    rate, shares = fit_rates(members, bound=1.0)
    found = members.withColumn("rate", rate).toPandas().sort_values("doc_id")["rate"].to_numpy()
    assert (found >= 0).all() and (found <= 1).all()
    kept = rng.random((200, len(p))) < found
    drawn = (kept * tokens) @ p
    assert np.allclose((drawn / drawn.sum(1, keepdims=True)).mean(0), shares, atol=0.003)
    # Low is short: it keeps all it has. Toxic is not, and comes down to its target.
    least, wanted = (p[:, 0] >= p.max(axis=1)) * 1.0, np.array([0.9, 0.05, 0.05]) * (tokens @ p)[0] / 0.9
    best, top = np.ones(len(p)), np.linalg.eigvalsh((p * tokens[:, None]).T @ p)[-1]
    for _ in range(20_000):
        best = np.clip(best + p @ (wanted - (best * tokens) @ p) / top, least, 1)
    loss = lambda r: (((r * tokens) @ p - wanted) ** 2).sum() / wanted.sum() ** 2
    assert loss(found) <= loss(best) + 1e-4 and shares[1] < 0.03 and abs(shares[2] - 0.05) < 0.01


def test_temperature_softens_a_net_that_is_too_sure():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 60))
    y = (rng.random(400) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    net = Net.fit(x, y, 2)
    assert net.arrays["temperature"] > 1
    assert np.allclose(Net.fit(x[:3], y[:3], 2).predict(x).std(0), 0)


def test_shapes():
    assert shape("Hello***".encode()) == b"Xx*" and shape("ÀB12c!".encode()) == b"X0x!"


def test_words_of_the_same_kinds_are_shaped_once():
    words = [w.encode() for w in ("abc", "xyz", "ÀB12c!", "ab٣", "漢字", "Ⅷ", "#--#", "a" * 90, "")] + [b"\xff\xfeA1"]
    buckets = Buckets(12)
    ids, shapes = buckets.of(words)
    # Character by character, by the definition.
    for word, one, two in zip(words, ids, shapes, strict=True):
        chars = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word.decode("utf-8", "replace"))
        runs = "".join(c for k, c in enumerate(chars) if not k or c != chars[k - 1]).encode()
        assert shape(word) == runs
        assert (one, two) == (xxhash.xxh3_64_intdigest(word) & 4095, xxhash.xxh3_64_intdigest(runs, 1) & 4095)
    assert buckets.shapes["xxx"] == int(shapes[0]) << 32 and len(buckets.shapes) == 8
