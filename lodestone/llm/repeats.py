"""The sparse front end of the substring operators: only text that can repeat is moved.

A window is ``length`` words. Its anchor is the k-gram of smallest hash in it, the leftmost of equal ones, so equal windows
have equal anchors in equal places, and a run of windows with one anchor is a segment of at most
``2 * length - k`` words. Segments whose anchor occurs once in the corpus can't repeat and stay where they are. The others
are dealt by anchor, to be compared exactly by the operator; anchors that occur more than ``hot`` times are dealt by whole
windows instead, after each task has kept only the first of equal windows. So a passage that a third of all documents
share leaves each task once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts_of
from .near_dedup import WordHashes, windows

#: A segment: where it starts, how many windows, how many words lie before the anchor, and its words.
Segment = tuple[int, int, int, int, int, list[bytes]]
#: (doc_id, uid, start, count): so many windows of a document, from a start on, occur earlier.
Repeat = tuple[int, int, int, int]

_SEGMENTS = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("uid", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("at", pa.int32()), ("words", pa.binary())]
)
_SEGMENTS_DDL = "key long, doc_id long, uid long, start int, count int, at int, words binary"
_REPEATS = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("start", pa.int32()), ("count", pa.int32())])
_REPEATS_DDL = "doc_id long, uid long, start int, count int"
#: Windows of hot anchors that a task holds to keep the first of equal ones.
HELD = 20_000


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of the smallest, the leftmost of equal ones."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    place, done = np.arange(len(values)), 1
    while done < width:
        step = min(done, width - done)
        a, b = place[:-step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        done += step
    return place


def anchors(hashes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-gram hashes, the anchor's place for every window start)."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = windows(hashes, k)
    return grams, sliding_argmin(grams, length - k + 1)


def _anchor_rows(length: int, k: int):
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, texts in texts_of(batch, "text", 128):
                parts = []
                for row, text in enumerate(texts, at):
                    grams, place = anchors(known.of(text.split()), length, k)
                    if len(place):
                        found, n = np.unique(grams[np.unique(place)], return_counts=True)
                        parts.append((found, np.full(len(found), ids[row]), n.astype(np.int32)))
                if parts:
                    found, doc, n = map(np.concatenate, zip(*parts, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(doc), pa.array(n)], schema=schema)

    return run


def _rows(rows: Iterable[tuple], schema: pa.Schema, most: int = 8000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, count) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _segment_rows(length: int, k: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = WordHashes()
        held: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        resolved = lambda doc, uid, start: (doc, doc, uid, start, 1, 0, None)
        for batch in batches:
            ids, uids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            lists, hots, copies = batch.column(3), batch.column(4), batch.column(5).to_pylist()
            for low, texts in texts_of(batch, "text", 64):
                for row, text in enumerate(texts, low):
                    doc, uid = int(ids[row]), int(uids[row])
                    if copies[row] and uid in copies[row]:
                        continue
                    words = text.split()
                    hashes = known.of(words)
                    grams, place = anchors(hashes, length, k)
                    repeated, hot = lists[row].values.to_numpy().view(np.uint64), hots[row].values.to_numpy(zero_copy_only=False)
                    own = grams[place]
                    order = np.argsort(repeated)
                    found = np.minimum(np.searchsorted(repeated[order], own), len(order) - 1)
                    match = repeated[order][found] == own
                    is_hot = match & hot[order][found]
                    cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
                    ends = np.r_[cut[1:], len(place)]
                    for a, b in zip(cut.tolist(), ends.tolist(), strict=True):
                        if match[a] and not is_hot[a]:
                            yield int(own[a].view(np.int64)), doc, uid, a, b - a, int(place[a]) - a, b" ".join(words[a : b - 1 + length])
                    if is_hot.any():
                        whole = windows(hashes, length)
                        for a in np.flatnonzero(is_hot).tolist():
                            name = (int(whole[a].view(np.int64)), b" ".join(words[a : a + length]))
                            mine, other = (doc, a, uid), held.get(name)
                            if other is None:
                                held[name] = mine
                            elif (other[0], other[1]) < (doc, a):
                                yield resolved(doc, uid, a)
                            elif (other[0], other[1]) > (doc, a):
                                held[name] = mine
                                yield resolved(other[0], other[2], other[1])
                            # An equal place is a repeated row: nothing is earlier.
                        if len(held) > HELD:
                            yield from ((key, d, u, a, 1, 0, w) for (key, w), (d, a, u) in held.items())
                            held.clear()
        yield from ((key, d, u, a, 1, 0, w) for (key, w), (d, a, u) in held.items())

    return lambda batches: _rows(of_task(batches), _SEGMENTS, 4000)


def _compared(compare: Callable[[Iterator[Segment], int], Iterator[Repeat]], length: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for low in range(0, batch.num_rows, 4000):
                    yield from zip(*(c.to_pylist() for c in batch.slice(low, 4000).columns), strict=True)

        stream = rows()
        row = next(stream, None)
        while row is not None:
            key, resolved = row[0], []

            def same_key() -> Iterator[Segment]:
                nonlocal row
                while row is not None and row[0] == key:
                    if row[6] is None:
                        resolved.append((row[1], row[2], row[3], row[4]))
                    else:
                        yield row[1], row[2], row[3], row[4], row[5], row[6]
                    row = next(stream, None)

            yield from compare(same_key(), length)
            yield from resolved

    return lambda batches: _rows(of_task(batches), _REPEATS, 20_000)


def copied(docs: DataFrame) -> DataFrame:
    """(doc_id, uid) of documents whose whole text a smaller doc_id has: nothing of them needs to be compared."""
    named = docs.select("doc_id", "uid", F.unhex(F.sha2("text", 256)).alias("digest"))
    # Written, so that the join shuffles both sides and can split a digest that a third of all documents have.
    firsts = stored(named.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first"), "firsts")
    return named.join(firsts, "digest").where("doc_id > first").select("doc_id", "uid").distinct()


def find_repeats(docs: DataFrame, copies: DataFrame, length: int, k: int, compare: Callable[[Iterator[Segment], int], Iterator[Repeat]], hot: int = 256) -> DataFrame:
    """Windows that occur earlier, as rows of ``_REPEATS_DDL``, in documents that aren't ``copies``.

    ``docs`` has doc_id (not null), text and uid. ``compare`` gets the segments of one key in the order of (doc_id, start)
    and yields the repeats among them. Earlier is a smaller (doc_id, start); rows of one document's copies under the same
    id are not earlier than each other.
    """
    rows = stored(docs.select("doc_id", "text").mapInArrow(_anchor_rows(length, k), "anchor long, doc_id long, n int"), "anchors")
    # Written, so that the join shuffles both sides and can split an anchor that a third of all documents have.
    twice = rows.groupBy("anchor").agg(F.sum("n").alias("n")).where("n >= 2").select("anchor", (F.col("n") > hot).alias("hot"))
    twice = stored(twice, "anchors-twice")
    listed = rows.drop("n").join(twice, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot").alias("hot"))
    known = copies.groupBy("doc_id").agg(F.collect_list("uid").alias("copies"))
    candidates = docs.join(listed.join(known, "doc_id", "left"), "doc_id").select("doc_id", "text", "uid", "anchors", "hot", "copies")
    segments = candidates.mapInArrow(_segment_rows(length, k), _SEGMENTS_DDL)
    dealt = segments.repartition("key").sortWithinPartitions("key", "doc_id", "start")
    return dealt.mapInArrow(_compared(compare, length), _REPEATS_DDL)


def _remover(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.string()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in texts_of(batch, "text", 128):
                rows = []
                part = batch.slice(low, len(texts))
                for doc, text, uid, found in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    words = text.split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    # Rows under one id may differ in text; each takes its own.
                    own = [(r["start"], r["count"]) for r in found or () if r["uid"] == uid]
                    if own and min(own)[0] < 0:
                        own = [(0, len(words) - length + 1)] if len(words) >= length else []
                    if own:
                        starts, counts = np.array(own).T
                        np.add.at(gone, starts, 1)
                        np.add.at(gone, np.minimum(starts + counts + length - 1, len(words)), -1)
                    mask = np.cumsum(gone[:-1]) > 0
                    spans = runs_of(mask)
                    kept, at = [], 0
                    for a, n in spans:
                        kept += words[at:a]
                        at = a + n
                    left = b" ".join(kept + words[at:])
                    rows.append((doc, len(words), int(mask.sum()), ",".join(f"{a}:{a + n}" for a, n in spans), left.decode("utf-8", "replace"), hashlib.sha256(left).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int, k: int, compare, hot: int = 256, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (word ranges removed), kept_text, kept_sha256.

    Words covered by a window that occurs earlier go. Null and empty texts have no words. Rows with a null id lose
    nothing and are no one's earlier occurrence. Repeated rows lose what one of them would. An empty table gives an
    empty result; other columns are not read.
    """
    # An alias that changes nothing would keep Spark from reading the shuffled texts twice instead of shuffling them twice.
    same = id_column == "doc_id" and dict(docs.dtypes)["doc_id"] == "bigint"
    plain = docs.select(F.col("doc_id") if same else F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")).withColumn("uid", F.xxhash64("text"))
    named = plain.where(F.col("doc_id").isNotNull())
    copies = stored(copied(named), "copies")
    repeats = find_repeats(named, copies, length, k, compare, hot).unionByName(copies.select("doc_id", "uid", F.lit(-1).alias("start"), F.lit(0).alias("count")))
    by_doc = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("uid", "start", "count")).alias("found"))
    rest = plain.where(F.col("doc_id").isNull()).select("doc_id", "text", "uid", F.lit(None).cast("array<struct<uid:bigint,start:int,count:int>>").alias("found"))
    whole = named.join(by_doc, "doc_id", "left").select("doc_id", "text", "uid", "found").unionByName(rest)
    return whole.mapInArrow(_remover(length), "doc_id long, n_words long, n_removed long, spans string, kept_text string, kept_sha256 string")
