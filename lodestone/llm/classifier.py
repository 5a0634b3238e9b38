"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer calibrated network.

Every word has a sparse random index vector; a word's vector is the sum of its neighbours' index vectors over the
training rows. A document's features are the means of its words' and of its word shapes' vectors and three counts.
Training takes at most ``SAMPLE_ROWS`` labelled rows, those of the smallest id hash; every document is scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .textnet import Buckets, Net, packed, unpacked

#: The bound on training rows, fewer if fewer are labelled.
SAMPLE_ROWS = 6000
#: Documents of a lower score are rejected.
THRESHOLD = 0.3
DIMENSIONS, BITS, WINDOW = 32, 15, 2


def index_vectors(seed: int = 7) -> np.ndarray:
    """Four entries of +1 or -1 in each bucket's vector."""
    rng = np.random.default_rng(seed)
    out = np.zeros((1 << BITS, DIMENSIONS), np.float32)
    rows = np.arange(1 << BITS)
    for _ in range(4):
        out[rows, rng.integers(0, DIMENSIONS, 1 << BITS)] = rng.choice([-1, 1], 1 << BITS)
    return out


def add_contexts(context: np.ndarray, index: np.ndarray, ids: np.ndarray) -> None:
    """Add to each word of one text the index vectors of the words at most ``WINDOW`` away."""
    for low in range(0, len(ids), 50_000):
        part = ids[max(0, low - WINDOW) : low + 50_000]
        for d in range(1, WINDOW + 1):
            for a, b in ((part[:-d], part[d:]), (part[d:], part[:-d])):
                if len(a):
                    order = np.argsort(a, kind="stable")
                    firsts = np.flatnonzero(np.diff(a[order], prepend=-1))
                    context[a[order][firsts]] += np.add.reduceat(index[b[order]], firsts, axis=0)


def features(words: list[bytes], buckets: Buckets, vectors: np.ndarray) -> np.ndarray:
    if not words:
        return np.zeros(2 * DIMENSIONS + 3, np.float32)
    ids, shapes = buckets.of(words)
    total = np.zeros(2 * DIMENSIONS + 3, np.float32)
    for low in range(0, len(ids), 50_000):
        total[:DIMENSIONS] += vectors[ids[low : low + 50_000]].sum(0)
        total[DIMENSIONS : 2 * DIMENSIONS] += vectors[shapes[low : low + 50_000]].sum(0)
    total /= len(words)
    total[-3:] = np.log1p(len(words)), len(set(words)) / len(words) ** 0.8, sum(map(len, words)) / len(words)
    return total


def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fit on (label, text) rows, all in one task: they are ``SAMPLE_ROWS`` at most."""
    buckets, index = Buckets(BITS), index_vectors()
    labels, texts = [], []
    for batch in batches:
        labels += batch.column(0).to_pylist()
        for _, some in texts_of(batch, "text"):
            texts += some
    context = np.zeros_like(index)
    for text in texts:
        for ids in buckets.of(text.split()):
            add_contexts(context, index, ids)
    size = np.linalg.norm(context, axis=1, keepdims=True)
    vectors = (context / np.maximum(size, 1e-6)).astype(np.float16)
    x = np.array([features(t.split(), buckets, vectors.astype(np.float32)) for t in texts] or np.zeros((0, 2 * DIMENSIONS + 3)))
    net = Net.fit(x, np.array(labels, np.int64), 2)
    yield pa.RecordBatch.from_arrays([pa.array([packed(vectors=vectors, **net.arrays)], pa.binary())], names=["model"])


def fold(id_column: Column) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int) -> DataFrame:
    """(label, text) of at most ``rows`` labelled documents outside fold 0, those of the smallest id hash.

    Rows without id or label are left out; of repeated labels of one document the larger counts.
    """
    known = labels.select(F.col("doc_id").alias("id"), label.cast("int").alias("label")).where(F.col("id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("id")) != 0))
    chosen = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    # The hint is safe: ``rows`` bounds it.
    pairs = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "id")
    # In id order: what is learned doesn't depend on which task's rows come first.
    return pairs.dropDuplicates(["id"]).repartition(1).sortWithinPartitions("id").select("label", "text")


def fitted(sample: DataFrame, train) -> bytes:
    """What ``train`` makes of the sample, in one task; of no rows at all Spark runs no task."""
    found = sample.mapInArrow(train, "model binary").collect()
    return bytes(found[0]["model"]) if found else next(iter(train(iter(())))).column(0)[0].as_py()


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """The model as bytes, about 2 MB whatever the corpus."""
    return fitted(labelled_sample(docs, labels, F.col("quality"), rows), train)


def _scores(shared) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Scores of a batch's texts by the broadcast model."""
    arrays = unpacked(shared.value)
    vectors, net, buckets = arrays.pop("vectors").astype(np.float32), Net(**arrays), Buckets(BITS)

    def of(batch: pa.RecordBatch) -> np.ndarray:
        found = [net.predict(np.array([features(t.split(), buckets, vectors) for t in texts]))[:, 1] for _, texts in texts_of(batch, "text")]
        return np.concatenate(found or [np.zeros(0)])

    return of


def score_quality(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as a text without words. A null doc_id counts as held out. Repeated rows are
    scored each; an empty table gives an empty result; no column but the text enters a score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose own text scores ``threshold`` or more, whatever their ids."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(shared)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
