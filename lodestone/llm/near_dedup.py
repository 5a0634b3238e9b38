"""MinHash near-deduplication with DartMinHash signatures.

An element of weight w owns the region [0, w) of a weight axis. Unit cells of weight and rank hold a Poisson number of
darts each, all fixed by hashes of the element and the cell, so every document throws the same darts at the same element.
Only darts up to a rank that leaves about k ln k + 2k of them are thrown; each falls to one of the k coordinates, and a
coordinate keeps its dart of earliest rank. Two signatures agree in a coordinate with probability of the weighted Jaccard
similarity. Elements are shingles, and a shingle weighs as much as it occurs. Coordinates are joined in bands.

Documents alike word for word are one class from the start and only the first of them is compared. What is wanted are
the components of the similarity graph, so pairs within a class found already need no comparison. Estimates far above
the threshold are links, those far below are none, and the others are decided on the shingles themselves.

First a bucket gives a spanning forest of its members by estimated similarity, and for every cluster it is sure of the
``BEYOND`` likeliest links beyond. Buckets of more than ``BLOCK`` members are dealt into blocks, otherwise in every band,
which share the bucket's first member; so members of a group of copies meet in many blocks. The buckets of the first
``EARLY`` bands come first and their links make classes; a bucket of the other bands gives only pairs that cross two of
these, or every band would give a group's links anew. Then buckets that gave less than all their pairs, and whose members
are still of several classes, are gone over again, the
members outside the bucket's largest class against each other and against those inside, in tiles of bounded size. There a
member whose shingles are, to more than a fifth, no other member's is put aside: it can have no link. The others' pairs that
cross two classes and aren't estimated far below the threshold are decided on their shingles at once, and only links go on,
one for a member and a class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_uid, texts_of
from .components import components

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: 40 bands of 6: a pair of similarity 0.8 shares none with probability (1 - 0.8**6)**40 = 5e-6.
BANDS, BAND_ROWS = 40, 6
#: Bands whose links make classes before the others are looked at: a pair of similarity 0.8 shares one with probability 0.91.
EARLY = 8
#: Members of a bucket that are compared with each other at once.
BLOCK = 256
#: Standard errors of an estimate beyond which it decides; links beyond a sure cluster that are tried.
SURE, BEYOND = 5.0, 4
CACHED_WORDS = 200_000
#: Members of a part of a large bucket, two of which are compared as a tile, and their shingles.
TILE, TILE_SHINGLES = 2048, 1 << 19

_U = np.uint64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), _U, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xorshift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of ``size`` words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = (total + hashes[k : k + n]) * _U(0x9E3779B97F4A7C15)
            total ^= total >> _U(29)
    return mixed(total)


def shingles(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles, sorted, and how often each occurs. A text of fewer words than a shingle has one, all its words."""
    if 0 < len(hashes) < size:
        return windows(hashes, len(hashes)) ^ _U(len(hashes)), np.ones(1, np.int64)
    return np.unique(windows(hashes, size), return_counts=True)


def occurrences(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A name for every occurrence, so that sets of names compare as the shingles do by weight."""
    which = np.repeat(np.arange(len(found)), counts)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        return np.where(turn == 0, found[which], mixed(found[which] + turn.astype(_U) * _U(0xD6E8FEB86659FD93)))


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def dart_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Signatures (docs x k) of weighted sets; ``owner`` tells whose each element is. A set without elements has zeros."""
    out = np.zeros((docs, k), _U)
    total = np.bincount(owner, weights, docs)
    todo = np.flatnonzero(total > 0)
    darts = k * np.log(k) + 2.0 * k
    with np.errstate(over="ignore"):
        while len(todo):
            place = np.full(docs, -1)
            place[todo] = np.arange(len(todo))
            mine = np.flatnonzero(place[owner] >= 0)
            limit = darts / total[owner[mine]]
            across, up = np.ceil(weights[mine]).astype(np.int64), np.ceil(limit).astype(np.int64)
            best, sign = np.full(len(todo) * k, np.inf), np.zeros(len(todo) * k, _U)
            # Cells are made in blocks so that memory doesn't follow the weights.
            cells = across * up
            ends = np.cumsum(cells)
            low = 0
            while low < len(mine):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + 400_000, side="right")))
                part = slice(low, high)
                which = np.repeat(np.arange(low, high), cells[part])
                number = np.arange(len(which)) - np.repeat(ends[part] - cells[part] - (ends[low - 1] if low else 0), cells[part])
                a, b = number // up[which], number % up[which]
                cell = mixed(elements[mine[which]] + mixed((a.astype(_U) << _U(32)) + b.astype(_U) + _U(1)))
                count = np.searchsorted(_POISSON, _unit(cell), side="right")
                which, a, b, cell, count = (np.repeat(x, count) for x in (which, a, b, cell, count))
                if len(which):
                    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                    turn = np.arange(len(cell)) - np.repeat(first, np.diff(np.r_[first, len(cell)]))
                    dart = mixed(cell + (turn.astype(_U) + _U(1)) * _U(0xD1B54A32D192ED03))
                    rank = b + _unit(mixed(dart ^ _U(0xA5A5A5A5A5A5A5A5)))
                    hit = (a + _unit(mixed(dart ^ _U(0x5A5A5A5A5A5A5A5A))) < weights[mine[which]]) & (rank < limit[which])
                    dart, rank, which = dart[hit], rank[hit], which[hit]
                    slot = place[owner[mine[which]]] * k + (mixed(dart) % _U(k)).astype(np.int64)
                    np.minimum.at(best, slot, rank)
                    won = best[slot] == rank
                    sign[slot[won]] = dart[won]
                low = high
            sign, empty = sign.reshape(len(todo), k), np.isinf(best).reshape(len(todo), k).any(1)
            out[todo[~empty]] = sign[~empty]
            todo, darts = todo[empty], 2 * darts
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(docs x bands) keys; equal keys mean equal rows of the same band."""
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), bands, rows)
        key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=_U)), (len(signatures), bands)).copy()
        for r in range(rows):
            key = mixed(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


_SIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("uid", pa.binary()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
_SIGNED_DDL = "row long, doc_id long, uid binary, digest binary, bands array<long>, sketch binary"


def signer(bands: int, rows: int, size: int):
    """Signatures; ``row`` is a number of the row's own, so that rows of one id with different texts are kept apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = WordHashes(), TaskContext.get()
        number = (task.partitionId() if task else 0) << 40
        for batch in batches:
            for at, texts in texts_of(batch, "text", 128):
                uids, digests, sets = [], [], []
                for text in texts:
                    words = text.split()
                    uids.append(hashlib.sha256(text).digest()[:16])
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    sets.append(shingles(known.of(words), size))
                owner = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
                elements, weights = (np.concatenate(x) for x in zip(*sets, strict=True))
                signed = dart_minhash(elements, weights.astype(np.float64), owner, len(sets), bands * rows)
                keys = band_keys(signed, bands, rows)
                lists = [k.view(np.int64) if len(s) else k[:0].view(np.int64) for k, (s, _) in zip(keys, sets, strict=True)]
                # Sixteen bits of a coordinate are enough to compare: they agree by chance once in 65536.
                sketches = [row.tobytes() for row in (signed & _U(0xFFFF)).astype("<u2")]
                columns = [pa.array(np.arange(number, number + len(texts))), batch.column(0).slice(at, len(texts)), *(pa.array(x, pa.binary()) for x in (uids, digests))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=_SIGNED)
                number += len(texts)

    return run


def shingler(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at, texts in texts_of(batch, "text", 64):
                sets = [occurrences(*shingles(known.of(t.split()), size)).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(sets, pa.list_(pa.int64()))], names=["row", "shingles"])

    return run


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("estimate", pa.float64())])


def block_pairs(sketches: np.ndarray, classes: np.ndarray, low: float, high: float) -> tuple[list[tuple[int, int, float]], bool]:
    """(i, j, estimate) of a block: its spanning forest over estimates of ``low`` or more, and of every cluster of
    estimates of ``high`` or more the ``BEYOND`` likeliest pairs with members of other clusters. And whether there are
    more pairs of clusters with an estimate of ``low`` or more. Members of one of the ``classes`` are linked already:
    they are of one cluster and their pairs aren't given."""
    n = len(sketches)
    like = np.empty((n, n), np.float32)
    for i in range(n):
        like[i] = (sketches == sketches[i]).mean(1)
    like[classes[:, None] == classes[None, :]] = 2
    np.fill_diagonal(like, -1)
    best, source, left = np.full(n, -1.0, np.float32), np.zeros(n, int), np.ones(n, bool)
    group = np.arange(n)
    out: dict[tuple[int, int], float] = {}
    for _ in range(n):
        i = int(np.argmax(np.where(left, best, -2)))
        left[i] = False
        if best[i] >= low:
            j = int(source[i])
            if classes[i] != classes[j]:
                out[min(i, j), max(i, j)] = float(best[i])
            if best[i] >= high:
                group[i] = group[j]
        closer = left & (like[i] > best)
        best[closer], source[closer] = like[i][closer], i
    outside = np.where(group[:, None] != group[None, :], like, -1)
    for g in np.unique(group):
        mine = np.flatnonzero(group == g)
        part = outside[mine].ravel()
        for at in np.argsort(-part, kind="stable")[:BEYOND]:
            if part[at] < low:
                break
            i, j = int(mine[at // n]), int(at % n)
            out[min(i, j), max(i, j)] = float(part[at])
    taken = sum(group[i] != group[j] for i, j in out)
    return [(i, j, e) for (i, j), e in out.items()], np.count_nonzero(outside >= low) > 2 * taken


def _pairs(low: float, high: float):
    """Pairs of the blocks; rows come sorted by (key, block). A block with more pairs gives a row of its key, b null."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, float]]:
        name, ids, sketches, classes = None, [], [], []

        def close() -> Iterator[tuple[int, int | None, float]]:
            more = False
            if len(set(classes)) < 2:
                found = []
            elif len(ids) == 2:
                found = [(0, 1, float((np.frombuffer(sketches[0], "<u2") == np.frombuffer(sketches[1], "<u2")).mean()))]
                found = [x for x in found if x[2] >= low]
            else:
                found, more = block_pairs(np.stack([np.frombuffer(x, "<u2") for x in sketches]), np.array(classes), low, high)
            if more:
                yield name[0], None, low
            for i, j, e in found:
                if ids[i] != ids[j]:
                    yield min(ids[i], ids[j]), max(ids[i], ids[j]), e

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != name:
                    yield from close()
                    name, ids, sketches, classes = row[:2], [], [], []
                ids.append(row[2])
                sketches.append(row[3])
                classes.append(row[4])
        yield from close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        # A pair meets in many buckets of a task; the last ones are remembered.
        seen: set[tuple[int, int]] = set()
        for a, b, e in of_task(batches):
            if (a, b) in seen:
                continue
            seen.add((a, b))
            held.append((a, b, e))
            if len(held) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _FOUND.types, strict=True)], schema=_FOUND)
                held = []
                if len(seen) > 500_000:
                    seen.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _FOUND.types, strict=True)], schema=_FOUND)

    return run


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose shingle sets' Jaccard similarity reaches the threshold."""
    of_a = sets.select(F.col("row").alias("a"), F.col("shingles").alias("sa"))
    of_b = sets.select(F.col("row").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    met = both >= similarity * (F.size("sa") + F.size("sb") - both) - 1e-9
    return pairs.join(of_a, "a").join(of_b, "b").where(met).select("a", "b")


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each value of ``names``; rows come sorted by them."""
    name, held = None, []
    for batch in batches:
        values = [batch.column(n).to_numpy() for n in names]
        cuts = [*(np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1)] if batch.num_rows else []
        for at, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True) if batch.num_rows else ():
            now = tuple(v[at] for v in values)
            if now != name and held:
                yield pa.Table.from_batches(held)
                held = []
            name = now
            held.append(batch.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held)


class Sets:
    """Shingle sets, by place: their sizes and how much one has in common with others."""

    def __init__(self, lists: pa.ListArray):
        self.sizes = lists.value_lengths().to_numpy()
        _, self.names, self.seen = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        self.starts, self.mark = np.cumsum(self.sizes) - self.sizes, np.zeros(len(self.seen), bool)

    def shared(self) -> np.ndarray:
        """How many of each set's shingles another set has too."""
        known = np.r_[0, np.cumsum(self.seen[self.names] > 1)]
        return known[self.starts + self.sizes] - known[self.starts]

    def similar(self, one: int, others: np.ndarray, similarity: float) -> np.ndarray:
        """Which of the ``others`` reach the threshold with ``one``."""
        met = np.zeros(len(others), bool)
        own = self.names[self.starts[one] : self.starts[one] + self.sizes[one]]
        self.mark[own] = True
        for low in range(0, len(others), 256):
            some = others[low : low + 256]
            ends = np.cumsum(self.sizes[some])
            places = np.arange(ends[-1]) + np.repeat(self.starts[some] - (ends - self.sizes[some]), self.sizes[some])
            marked = np.r_[0, np.cumsum(self.mark[self.names[places]])]
            both = marked[ends] - marked[ends - self.sizes[some]]
            met[low : low + len(some)] = both >= similarity * (len(own) + self.sizes[some] - both) - 1e-9
        self.mark[own] = False
        return met


def _crossing(low: float, similarity: float):
    """Links of a tile between two classes, one for a member and a class; a pair is looked at in its first shared band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["key", "i", "j"]):
            sets = Sets(rows["shingles"].combine_chunks())
            # A similar pair has four fifths of each of the two in common.
            able = np.flatnonzero(sets.shared() >= similarity * sets.sizes - 1e-9)
            if len(able) < 2:
                continue
            classes = rows["class"].to_numpy()[able]
            order = np.argsort(classes, kind="stable")
            classes, at = classes[order], able[order]
            ids, part = rows["member"].to_numpy()[at], rows["part"].to_numpy()[at]
            key, one = rows["key"][0].as_py(), rows["i"][0].as_py() == rows["j"][0].as_py()
            table = rows.take(at)
            sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u2").reshape(len(at), -1)
            bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(at), -1)
            after, found = np.searchsorted(classes, classes, side="right"), []
            for r in range(len(at)):
                if after[r] == len(at):
                    break
                like = np.count_nonzero(sketches[after[r] :] == sketches[r], axis=1) / sketches.shape[1]
                hit = after[r] + np.flatnonzero(like >= low)
                if not one:
                    hit = hit[part[hit] != part[r]]
                if len(hit):
                    hit = hit[bands[hit, (bands[hit] == bands[r]).argmax(1)] == key]
                if len(hit):
                    hit = hit[sets.similar(int(at[r]), at[hit], similarity)]
                    hit = hit[np.unique(classes[hit], return_index=True)[1]]
                    found += [(int(ids[r]), int(ids[h])) for h in hit]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return run


def _sets(named: DataFrame, signed: DataFrame, ends: DataFrame, size: int, name: str) -> DataFrame:
    """(row, shingles) of the rows ``ends``. Merged, at every size: what is joined grows with the corpus."""
    wanted = signed.select("row", "doc_id", "uid").join(ends, "row", "left_semi")
    texts = named.withColumn("uid", text_uid(F.col("text"))).join(wanted.hint("merge"), ["doc_id", "uid"])
    return stored(texts.groupBy("row").agg(F.min("text").alias("text")).mapInArrow(shingler(size), "row long, shingles array<long>"), name)


def _several(buckets: DataFrame, low_ids: DataFrame, name: str) -> DataFrame:
    """The rows of buckets whose members are of several classes, with their ``class``."""
    known = buckets.join(low_ids, F.col("member") == F.col("first"), "left").select(*buckets.columns, F.coalesce("low", "member").alias("class"))
    known = stored(known, f"{name}-buckets")
    several = stored(known.groupBy("key").agg(F.min("class").alias("m"), F.max("class").alias("n")).where("m < n").select("key"), f"{name}-several")
    return stored(known.join(several, "key"), f"{name}-members")


def _block_links(buckets: DataFrame, signed: DataFrame, sets: DataFrame, low: float, high: float, similarity: float, name: str) -> tuple[DataFrame, DataFrame]:
    """The links (u, v) that the blocks of ``buckets`` give, and the keys of those with more pairs than they gave."""
    centres = buckets.where("member = centre AND blocks > 1").select("key", "member", "class", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.col("block").alias("own")).where("block <> own")
    dealt = buckets.select("key", "block", "member", "class").unionByName(centres.select("key", "block", "member", "class"))
    sketched = dealt.join(signed.select(F.col("row").alias("member"), "sketch"), "member").select("key", "block", "member", "sketch", "class")
    found = sketched.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(_pairs(low, high), "a long, b long, estimate double")
    found = stored(found.groupBy("a", "b").agg(F.max("estimate").alias("estimate")), name)
    pairs = found.where("b IS NOT NULL")
    links = pairs.where(F.col("estimate") >= high).select("a", "b").unionByName(_similar(pairs.where(F.col("estimate") < high).select("a", "b"), sets, similarity))
    return links.toDF("u", "v"), found.where("b IS NULL").select(F.col("a").alias("key"))


def _rest(known: DataFrame, spans: DataFrame, sets: DataFrame, signed: DataFrame, low: float, similarity: float) -> DataFrame:
    """The links (u, v) between classes among the members ``known`` of the buckets ``spans``."""
    hashed, is_top = F.xxhash64("key", "member"), F.col("class") == F.col("top")
    parts = known.join(spans, "key").select(
        "key",
        "member",
        "class",
        F.when(is_top, F.col("others") + F.pmod(hashed, "inside")).otherwise(F.pmod(hashed, "others")).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(is_top, F.col("others")).otherwise(F.col("others") + F.col("inside")) - 1)).alias("mate"),
    )
    whole = sets.join(signed.select("row", "sketch", "bands"), "row").withColumnRenamed("row", "member")
    tiles = parts.join(whole, "member").select("key", F.least("part", "mate").alias("i"), F.greatest("part", "mate").alias("j"), "member", "class", "part", "sketch", "bands", "shingles")
    return tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_crossing(low, similarity), "u long, v long")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = BAND_ROWS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), kept, and uid (see ``text_uid``).

    Classes are the connected components of pairs whose ``size``-word shingles, each as often as it occurs, have a Jaccard
    similarity of ``similarity`` or more. Texts with the same words in the same order are one class, among them all empty
    and null texts; a text shorter than a shingle is otherwise like none. Of a class the row of the smallest doc_id is
    kept; if that has several texts there, one of them. Rows with a null id are classes of their own, class_id null, and
    kept. Repeated rows, id and text alike, get the same class and are kept or not together; rows of one id with different
    texts are compared each. An empty table gives an empty result.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    named = plain.where(F.col("doc_id").isNotNull())
    signed = stored(named.mapInArrow(signer(bands, rows, size), _SIGNED_DDL), "signatures")
    firsts = signed.groupBy("digest").agg(F.min(F.struct("doc_id", "uid", "row")).alias("f"))
    firsts = stored(firsts.select("digest", F.col("f.row").alias("first"), F.col("f.doc_id").alias("least"), F.col("f.uid").alias("least_uid")), "firsts")
    keyed = signed.join(firsts, (signed["digest"] == firsts["digest"]) & (signed["row"] == firsts["first"]), "left_semi").select(F.col("row").alias("member"), F.posexplode("bands").alias("band", "key"))
    # Written, so that the join shuffles both sides and can split a key that a third of all documents have.
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("member").alias("centre")).where("n > 1"), "shared")
    blocks = F.ceil(F.col("n") / BLOCK)
    buckets = stored(keyed.join(shared, "key").select("key", "member", "band", F.pmod(F.xxhash64("key", "member"), blocks).alias("block"), blocks.alias("blocks"), "centre"), "buckets")
    sets = _sets(named, signed, buckets.select(F.col("member").alias("row")).distinct(), size, "shingles")
    error = (similarity * (1 - similarity) / (bands * rows)) ** 0.5
    low, high = similarity - (SURE + 1) * error, min(1.0, similarity + SURE * error)
    links, more = _block_links(buckets.where(F.col("band") < EARLY).withColumn("class", F.col("member")), signed, sets, low, high, similarity, "pairs")
    low_ids = components(links).toDF("first", "low")
    late = _several(buckets.where(F.col("band") >= EARLY), low_ids, "late")
    links, more_late = _block_links(late, signed, sets, low, high, similarity, "late-pairs")
    low_ids = components(low_ids.toDF("u", "v").unionByName(links)).toDF("first", "low")
    # What the blocks left out can still matter where it joins two of these classes.
    keys = shared.where(F.col("n") > BLOCK).select("key").union(more).union(more_late).distinct()
    if not keys.isEmpty():
        known = _several(buckets.select("key", "member").join(keys, "key"), low_ids, "rest")
        wanted = sets.join(known.select(F.col("member").alias("row")).distinct(), "row", "left_semi")
        sized = known.join(wanted.select(F.col("row").alias("member"), F.size("shingles").cast("long").alias("size")), "member")
        spans = sized.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("size").alias("size")).groupBy("key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "size", "class")).alias("top"))
        parts = lambda n, size: F.ceil(F.greatest(n / TILE, size / TILE_SHINGLES))
        spans = stored(spans.select("key", parts(F.col("n") - F.col("top.n"), F.col("size") - F.col("top.size")).alias("others"), parts(F.col("top.n"), F.col("top.size")).alias("inside"), F.col("top.class").alias("top")), "rest-keys")
        joined = _rest(known, spans, wanted, signed, low, similarity)
        low_ids = components(low_ids.toDF("u", "v").unionByName(joined)).toDF("first", "low")
    # The row to keep of classes of several texts; written, since a class may have a third of all documents.
    linked = firsts.join(low_ids, "first")
    roots = linked.select(F.col("low").alias("root"), "least", "least_uid").unionByName(firsts.join(low_ids.select(F.col("low").alias("first")).distinct(), "first", "left_semi").select(F.col("first").alias("root"), "least", "least_uid"))
    heads = stored(roots.groupBy("root").agg(F.min(F.struct("least", "least_uid")).alias("head")), "heads")
    named_classes = firsts.join(low_ids, "first", "left").withColumn("root", F.coalesce("low", "first")).join(heads, "root", "left")
    named_classes = stored(named_classes.select("digest", F.coalesce("head.least", "least").alias("class_id"), F.coalesce("head.least_uid", "least_uid").alias("keep_uid")), "classes")
    kept = (F.col("doc_id") == F.col("class_id")) & (F.col("uid") == F.col("keep_uid"))
    classes = signed.select("doc_id", "digest", "uid").join(named_classes, "digest").select("doc_id", "class_id", kept.alias("kept"), "uid")
    nameless = plain.where(F.col("doc_id").isNull()).select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"), text_uid(F.col("text")).alias("uid"))
    return classes.unionByName(nameless)
