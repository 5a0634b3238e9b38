"""Soft-membership mixing of domains to target weights.

A classifier trained on the labelled table gives each document posteriors of the domains. Nonnegative document rates are
fitted by projected-gradient least squares, so that the expected tokens of each domain, summed over rate times tokens
times posterior, meet the targets. A step is one distributed sum of as many numbers as there are pairs of domains.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classifier import fitted, labelled_sample
from .common import stored, text_uid, texts_of
from .textnet import Buckets, Net, packed, unpacked

DOMAINS = ("clean", "low", "toxic")
#: Shares of the expected tokens.
TARGETS = {"clean": 0.9, "low": 0.05, "toxic": 0.05}
#: The bound on labelled rows the classifier sees.
SAMPLE_ROWS = 6000
BITS, LEAST_DOCS = 18, 5


def domain_label() -> Column:
    """Toxic before low before clean; null where a label is missing."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)


def log_odds(seen: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of words found in so many documents of each domain; 0 for words of fewer than ``LEAST_DOCS`` documents."""
    share = (seen + 0.5) / (size + 1.0)
    rest = (seen.sum(1, keepdims=True) - seen + 0.5) / (size.sum() - size + 1.0)
    return np.where(seen.sum(1, keepdims=True) >= LEAST_DOCS, np.log(share / rest), 0)


def features(ids: np.ndarray, shapes: np.ndarray, n_words: int, own: np.ndarray, shaped: np.ndarray) -> np.ndarray:
    """Per domain the mean, the largest and the second largest log-odds over the text's distinct words and shapes."""
    k = own.shape[1]
    if not n_words:
        return np.zeros(4 * k + 2)
    top = np.partition(own, len(own) - 2, axis=0)[-2:] if len(own) > 1 else own
    return np.concatenate([own.mean(0), shaped.mean(0), top[-1], top[0], np.log1p([n_words, len(ids) / n_words**0.8])])


def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets, labels, found = Buckets(BITS), [], []
    k = len(DOMAINS)
    seen = np.zeros((1 << BITS, k), np.float32)
    for batch in batches:
        labels += batch.column(0).to_pylist()
        for _, texts in texts_of(batch, "text"):
            for text in texts:
                words = text.split()
                ids, shapes = buckets.of([*set(words)])
                found.append((ids.astype(np.int32), np.unique(shapes).astype(np.int32), len(words)))
    y = np.array(labels, np.int64)
    for (ids, shapes, _), label in zip(found, y, strict=True):
        seen[np.union1d(ids, shapes), label] += 1
    size = np.bincount(y, minlength=k).astype(np.float32)
    x = np.zeros((len(y), 4 * k + 2))
    for row, ((ids, shapes, n), label) in enumerate(zip(found, y, strict=True)):
        # Odds without the row itself; else a word would tell the label of the row that it was learned from.
        own = np.eye(k, dtype=np.float32)[label]
        x[row] = features(ids, shapes, n, log_odds(seen[ids] - own, size - own), log_odds(seen[shapes] - own, size - own))
    net = Net.fit(x, y, k)
    yield pa.RecordBatch.from_arrays([pa.array([packed(odds=log_odds(seen, size).astype(np.float16), **net.arrays)], pa.binary())], names=["model"])


def fit_domains(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """The classifier as bytes, about 2 MB whatever the corpus."""
    return fitted(labelled_sample(docs, labels, domain_label(), rows), train)


def posteriors(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, uid (see ``text_uid``), n_tokens (words) and p_<domain> of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = len(DOMAINS)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = unpacked(shared.value)
        odds, net, buckets = arrays.pop("odds").astype(np.float32), Net(**arrays), Buckets(BITS)
        for batch in batches:
            tokens, found = [], [np.zeros((0, k))]
            for _, texts in texts_of(batch, "text"):
                rows = []
                for text in texts:
                    words = text.split()
                    ids, shapes = buckets.of([*set(words)])
                    shapes = np.unique(shapes)
                    tokens.append(len(words))
                    rows.append(features(ids, shapes, len(words), odds[ids], odds[shapes]))
                found.append(net.predict(np.array(rows)))
            p = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), *(pa.array(p[:, c]) for c in range(k))], names=["doc_id", "uid", "n_tokens", *(f"p_{d}" for d in DOMAINS)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_uid(F.col("text")).alias("uid")).mapInArrow(
        predict, "doc_id long, uid binary, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS)
    )


def _sums(moves: list[np.ndarray], choices: list[np.ndarray], names: list[str], anchor: int | None, most: float):
    """Per task and choice of the next move: the domains' expected tokens, then the Gram matrix of the free documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(names)
        total = np.zeros((len(choices), k + k * k))
        for batch in batches:
            p = np.stack([batch.column(f"p_{d}").to_numpy() for d in names], axis=1)
            tokens = batch.column("n_tokens").to_numpy().astype(float)
            rate, least = np.ones(len(tokens)), np.zeros(len(tokens))
            if anchor is not None:
                least[p[:, anchor] >= p.max(axis=1)] = 1.0
            for move in moves:
                rate = np.clip(rate + p @ move, least, most)
            for c, move in enumerate(choices):
                moved = np.clip(rate + p @ move, least, most)
                total[c, :k] += (moved * tokens) @ p
                total[c, k:] += ((p * (tokens * ((moved > least) & (moved < most)))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])

    return run


def fit_rates(
    members: DataFrame, targets: Mapping[str, float] = TARGETS, total: float | None = None, protect: bool = True, steps: int = 30, tolerance: float = 1e-3, bound: float = float("inf")
) -> tuple[Column, list[float]]:
    """(rate as an expression over ``members``' posteriors, the expected share of each domain it gives).

    From rates of 1, each step moves every rate along its posteriors and projects onto the least rate, 0 or 1, and
    ``bound``, which is 1 where rows can't be repeated. The move is
    the gradient, plain with a step that always descends or a multiple of it, or scaled with the inverse Gram
    matrix of the documents whose rate isn't held at 0, whole or in part; one distributed pass weighs all of these and
    the best is taken. ``total`` is the expected tokens altogether; by default as many as leave the domain
    of the largest weight what it has. With ``protect`` the rates of documents most likely of that domain don't fall
    below 1, however weak the classifier. Targets that can't be reached are met as nearly as least squares allow.
    """
    names = list(targets)
    weights = np.array([targets[d] for d in names], float) / sum(targets.values())
    k, anchor = len(names), int(np.argmax(weights))

    def weighed(moves: list[np.ndarray], choices: list[np.ndarray]) -> np.ndarray:
        found = members.mapInArrow(_sums(moves, choices, names, anchor if protect else None, bound), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(choices) * (k + k * k))
        for row in found:
            out[row["place"]] = row["value"]
        return out.reshape(len(choices), k + k * k)

    moves: list[np.ndarray] = []
    now = weighed(moves, [np.zeros(k)])[0]
    wanted = weights * (now[anchor] / weights[anchor] if total is None else total)
    loss = lambda x: float(((x[:k] - wanted) ** 2).sum())
    # The largest eigenvalue of the whole Gram matrix is at most all tokens, whose sum over domains this is.
    most = max(float(now[:k].sum()), 1e-12)
    for _ in range(steps):
        off, gram = wanted - now[:k], now[k:].reshape(k, k)
        if np.abs(off).max(initial=0) <= tolerance * max(1.0, wanted.sum()):
            break
        ridge = 1e-6 * max(np.linalg.eigvalsh(gram)[-1], 1e-6 * most)
        scaled = np.linalg.solve(gram + ridge * np.eye(k), off)
        choices = [*(off * f / most for f in (1, 4, 16)), *(scaled * f for f in (1.0, 0.3, 0.1, 0.03))]
        # Sums of floating point numbers differ in their last digits from run to run; the moves needn't.
        choices = [np.array([float(f"{x:.6g}") for x in c]) for c in choices]
        found = weighed(moves, choices)
        best = min(range(len(choices)), key=lambda c: loss(found[c]))
        if loss(found[best]) >= loss(now) * (1 - 1e-3):
            break
        moves.append(choices[best])
        now = found[best]
    p = [F.col(f"p_{d}") for d in names]
    least = F.when(p[anchor] >= F.greatest(*p), 1.0).otherwise(0.0) if protect else F.lit(0.0)
    rate = F.lit(1.0)
    for move in moves:
        rate = F.least(F.lit(bound), F.greatest(least, rate + sum((x * float(m) for x, m in zip(p, move, strict=True)), F.lit(0.0))))
    return rate, [float(s) for s in now[:k] / max(now[:k].sum(), 1e-12)]


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, rows: int = SAMPLE_ROWS, bound: float = float("inf")) -> DataFrame:
    """Per document: doc_id, uid, n_tokens, p_<domain>, rate, ``copies`` and ``kept`` (there is a copy).

    ``copies`` is the rate rounded up or down by a draw of the row's hash, so that it is the rate in the mean; a rate above 1
    repeats a row. Where rows can't be repeated, a ``bound`` of 1 fits rates that a draw can honour. ``shares`` tells what
    the drawn copies reach.

    Null and empty texts have no tokens; their rate follows their posteriors. Repeated rows, id and text alike, share rate
    and draw. An empty table gives an empty result. Without labels all documents have equal posteriors.
    """
    members = stored(posteriors(docs, fit_domains(docs, labels, rows)), "posteriors")
    rate, _ = fit_rates(members, targets, bound=bound)
    draw = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "uid"), F.lit(1 << 30)) / F.lit(1 << 30)
    mixed = members.withColumn("rate", rate)
    mixed = mixed.withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
    return mixed.withColumn("kept", F.col("copies") > 0)


def shares(mixed: DataFrame, copies: str = "copies") -> dict[str, float]:
    """Each domain's share of the expected tokens of the drawn copies (or of the rates, with ``copies="rate"``)."""
    sums = mixed.agg(*[F.sum(F.col(copies) * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS]).first()
    whole = sum(x or 0.0 for x in sums)
    return {d: (sums[d] or 0.0) / whole if whole else 0.0 for d in DOMAINS}
