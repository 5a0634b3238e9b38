"""Best-fit packing by bin completion.

Only the number of pieces of each length matters for a packing, so the search runs on a histogram of at most
``capacity`` counts, whatever the corpus's size. It takes the largest length left, enumerates undominated fillings of
the rest of its sequence, prunes by waste, and applies a filling as many times at once as the counts allow. A best-fit
packing is the first incumbent. The found patterns are dealt back to the pieces by their rank among pieces of their
length.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

CAPACITY = 4096
END_ID = 1
#: Words of a generation whose ids a worker remembers.
CACHED_WORDS = 150_000

#: A tokenizer that cuts a text into letters, single digits and other characters this way. Fixed value.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of Latin letters alike in all normal forms, whose lower case is one letter each, and marks behind them.
PLAIN = "^(?P<stem>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+)(?P<tail>[-.,;:!?*%&$#|<>()]*)$"

Pattern = tuple[int, ...]


# ---- the search -------------------------------------------------------------------------------------------------


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: total length, and lengths that can't share (for each threshold k)."""
    total = -(-sum(k * n for k, n in counts.items()) // capacity)
    best = total
    big = [(k, n) for k, n in counts.items() if 2 * k > capacity]
    for k in {0, *(capacity - b for b, _ in big)} | {x for x in counts if 2 * x <= capacity}:
        alone = sum(n for x, n in counts.items() if x > capacity - k)
        half = [(x, n) for x, n in counts.items() if capacity - k >= x and 2 * x > capacity]
        small = sum(x * n for x, n in counts.items() if k <= x and 2 * x <= capacity)
        room = sum((capacity - x) * n for x, n in half)
        best = max(best, alone + sum(n for _, n in half) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Around the largest piece left, always the largest that still fits; equal sequences in one step."""
    left, out = dict(counts), []
    lengths = sorted(left, reverse=True)
    while lengths:
        lengths = [x for x in lengths if left[x]]
        if not lengths:
            break
        pattern, room = [], capacity
        for x in lengths:
            take = min(left[x], room // x)
            pattern += [x] * take
            room -= x * take
        out.append(_apply(left, tuple(pattern)))
    return out


def _apply(left: dict[int, int], pattern: Pattern) -> tuple[Pattern, int]:
    need: dict[int, int] = {}
    for x in pattern:
        need[x] = need.get(x, 0) + 1
    times = min(left[x] // n for x, n in need.items())
    for x, n in need.items():
        left[x] -= n * times
    return pattern, times


def fillings(lengths: list[int], place: dict[int, int], counts: list[int], head: int, capacity: int, spend: Callable[[], bool]) -> Iterator[Pattern]:
    """Undominated fillings around one piece of ``lengths[head]``, as places in the falling ``lengths``.

    ``place`` tells where a length stands. The lexicographically largest comes first. A filling is dominated if another piece still fits, if one of its pieces
    could give way to a longer one that is left, or if a single piece could fill the room that several share. ``spend``
    is asked before every step and ends the enumeration.
    """
    picked: list[tuple[int, int]] = [(head, 1)]
    left = lambda k: counts[k] - sum(n for j, n in picked if j == k)

    def spare_between(low: int, high: int) -> bool:
        """Is a piece left that is longer than ``low`` and no longer than ``high``?"""
        k = bisect.bisect_left(lengths, -high, key=lambda x: -x)
        while k < len(lengths) and lengths[k] > low:
            if left(k):
                return True
            k += 1
        return False

    def descend(at: int, room: int) -> Iterator[Pattern]:
        if not spend():
            return
        exact = place.get(room)
        if exact is not None and left(exact):
            # It dominates all else that fits here; if it is longer than the last piece, it has come before that.
            if exact >= at:
                yield tuple(j for j, n in [*picked, (exact, 1)] for _ in range(n))
            return
        fits = False
        for k in range(max(at, bisect.bisect_left(lengths, -room, key=lambda x: -x)), len(lengths)):
            # The pieces picked are all longer, but for the head.
            most = min(counts[k] - (k == head), room // lengths[k])
            fits = fits or most > 0
            for n in range(most, 0, -1):
                picked.append((k, n))
                yield from descend(k + 1, room - n * lengths[k])
                picked.pop()
            if not spend():
                return
        if not fits and not spare_between(0, room) and not any(spare_between(lengths[j], lengths[j] + room) for j, _ in picked[1:]):
            yield tuple(j for j, n in picked for _ in range(n))

    return descend(head, capacity - lengths[head])


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = 200_000) -> list[tuple[Pattern, int]]:
    """(pattern, times) of a packing with as few sequences as found; optimal if it meets ``lower_bound``.

    Depth first: around the largest piece left every undominated filling is tried, from as many times as the counts allow
    down to once. Fillings of one largest length are used in their order, so that no set of sequences is tried twice. A
    branch ends when its waste so far and the length left can't give fewer sequences than the incumbent. ``nodes`` bounds
    the steps of the whole search; when they are used up the incumbent stands, and may not be optimal if it is above
    ``lower_bound``. A search that ends before has proved its packing optimal.
    """
    counts = {x: n for x, n in counts.items() if n}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    lengths = sorted(counts, reverse=True)
    place = {x: k for k, x in enumerate(lengths)}
    left, rest = [counts[x] for x in lengths], sum(x * n for x, n in counts.items())
    steps = itertools.repeat(True, nodes)
    spend = lambda: next(steps, False)

    def options(head: int, after: Pattern) -> Iterator[tuple[Pattern, int]]:
        for filling in fillings(lengths, place, left, head, capacity, spend):
            if filling > after:
                for times in range(min(left[k] // filling.count(k) for k in set(filling)), 0, -1):
                    yield filling, times

    def use(filling: Pattern, times: int) -> None:
        nonlocal rest
        for k in filling:
            left[k] -= times
            rest -= times * lengths[k]

    plan: list[tuple[Pattern, int]] = []
    used, stack = 0, [options(0, ())]
    while stack and fewest > bound:
        if len(plan) == len(stack):
            filling, times = plan.pop()
            use(filling, -times)
            used -= times
        step = next(stack[-1], None) if spend() else None
        if step is None:
            stack.pop()
            continue
        plan.append(step)
        use(*step)
        used += step[1]
        if used + -(-rest // capacity) >= fewest:
            continue
        if not rest:
            best, fewest = [(tuple(lengths[k] for k in f), n) for f, n in plan], used
            continue
        head = step[0][0]
        if left[head]:
            stack.append(options(head, step[0]))
        else:
            stack.append(options(next(k for k in range(head + 1, len(lengths)) if left[k]), ()))
    return best


# ---- tokens -----------------------------------------------------------------------------------------------------


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and joins nothing across it, so ids of a text are those of its words in order. A batch's
    distinct words are found and their ids put in the words' places by Arrow. Ids of words are remembered, in two
    generations: when the young one is full it becomes the old one, and words still in use are taken over from there. So
    frequent words stay and memory is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # A special token cuts a text before anything else looks at it, so words between two of them are encoded alone.
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.cut_id, self.cut = special[-1] if special else (None, "")
        self.light, self.ends = None, None
        if cuts_plain_words(json.loads(self.tokenizer.to_str())):
            # Plain words in lower case need no normalising and no patterns, only byte characters and merges.
            self.light = Tokenizer(self.tokenizer.model)
            parts = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            self.light.pre_tokenizer = pre_tokenizers.Sequence(parts)
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True

    def encode(self, texts: pa.Array) -> Iterator[memoryview]:
        """The ids of each text, of a batch without nulls."""
        lists = pc.ascii_split_whitespace(texts)
        found = lists.flatten().dictionary_encode()
        placed = self._ids(found.dictionary).take(found.indices)
        ends = np.frombuffer(placed.buffers()[1], np.int32)[placed.offset : placed.offset + len(placed) + 1]
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        data = memoryview(placed.buffers()[2] or b"")
        return (data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))

    def _ids(self, words: pa.Array) -> pa.Array:
        """Plain words are looked up by their lower case, and what stands behind them by itself."""
        if not self.light:
            return self._known(words, False)
        parts = pc.extract_regex(words, PLAIN)
        stems, tails = pc.utf8_lower(pc.struct_field(parts, "stem")).dictionary_encode(), pc.fill_null(pc.struct_field(parts, "tail"), "").dictionary_encode()
        rest = words.filter(pc.is_null(stems.indices))
        out = pc.binary_join_element_wise(self._known(stems.dictionary, True).take(stems.indices), self._known(tails.dictionary, False).take(tails.indices), b"")
        return pc.replace_with_mask(out, pc.is_null(stems.indices), self._known(rest, False))

    def _known(self, words: pa.Array, plain: bool) -> pa.Array:
        names = words.cast(pa.binary()).to_pylist()
        ids = [*map(self.young.get, names)]
        if None in ids:
            fresh = [w for w, i in zip(names, ids, strict=True) if i is None]
            again = {w: self.old[w] for w in fresh if w in self.old}
            self.young |= again
            if len(again) < len(fresh):
                (self._encode_plain if plain else self._encode)([w for w in fresh if w not in again])
            ids = [*map(self.young.__getitem__, names)]
        if len(self.young) > CACHED_WORDS:
            self.young, self.old = {}, self.young
        return pa.array(ids, pa.binary())

    def _encode_plain(self, words: list[bytes]) -> None:
        groups = [words[k : k + 1024] for k in range(0, len(words), 1024)]
        for group, one in zip(groups, self.light.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.asarray(one.ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            data = ids.tobytes()
            self.young.update(zip(group, [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))

    def _encode(self, words: list[bytes]) -> None:
        odd = [] if self.cut else words
        groups = [words[k : k + 256] for k in range(0, len(words), 256)] if self.cut else []
        joined = [b" ".join(g).decode("utf-8", "replace").replace(" ", self.cut) for g in groups]
        for group, one in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.asarray(one.ids, "<u4")
            cuts = 4 * np.flatnonzero(ids == self.cut_id)
            if len(cuts) != len(group) - 1:  # a word has the special token itself
                odd = [*odd, *group]
                continue
            data = ids.tobytes()
            self.young.update(zip(group, [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)], strict=True)], strict=True))
        alone = [w.decode("utf-8", "replace") for w in odd]
        for word, one in zip(odd, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.young[word] = np.asarray(one.ids, "<u4").tobytes()


def cuts_plain_words(config: dict) -> bool:
    """Does a tokenizer's definition treat a plain word as its lower case, one part of its own, with a mark at its end?"""
    normal, cut, model = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}, config["model"]
    parts = cut.get("pretokenizers") or [{}]
    return (
        [x["type"] for x in normal.get("normalizers") or []] == ["NFC", "Replace", "Lowercase"]
        and [x.get("type") for x in parts] == ["Split", "ByteLevel"]
        and (parts[0]["pattern"], parts[0]["behavior"], parts[0]["invert"]) == ({"Regex": WORD_PARTS}, "Removed", True)
        and not (parts[1]["add_prefix_space"] or parts[1]["use_regex"])
        and (model["type"], model["dropout"], model["continuing_subword_prefix"]) == ("BPE", None, None)
        and bool(model["end_of_word_suffix"])
    )


#: One for each tokenizer in a worker; workers outlive tasks.
_WORDS: dict[str, WordIds] = {}


def word_ids(path: str | None) -> WordIds:
    path = path or public_tokenizer()
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(capacity: int, end_id: int, path: str | None, with_ids: bool):
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, encoded in zip(part.column(0).to_pylist(), words.encode(pc.fill_null(part.column(1), "")), strict=True):
                    size = len(encoded) // 4 + 1
                    for piece, start in enumerate(range(0, size, capacity)):
                        ids = encoded[4 * start : 4 * (start + capacity)]
                        if start + capacity >= size:
                            ids = bytes(ids) + end
                        rows.append((doc_id, piece, start, len(ids) // 4, zlib.crc32(ids), ids)[: len(schema)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


# ---- dealing patterns to pieces ---------------------------------------------------------------------------------


class Slots:
    """For each length, where its pieces go: the k-th run of ranks starts at ``first[k]``."""

    def __init__(self, plan: list[tuple[Pattern, int]]):
        taken: dict[int, int] = {}
        runs: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for pattern, times in plan:
            offset = 0
            for x in pattern:
                rank = taken.get(x, 0)
                runs.setdefault(x, []).append((rank, sequence - rank, offset))
                taken[x] = rank + times
                offset += x
            sequence += times
        self.runs = {x: np.array(r, np.int64) for x, r in runs.items()}

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for x in np.unique(lengths):
            at = np.flatnonzero(lengths == x)
            runs = self.runs[int(x)]
            k = np.searchsorted(runs[:, 0], ranks[at], side="right") - 1
            sequence[at], offset[at] = runs[k, 1] + ranks[at], runs[k, 2]
        return sequence, offset


def best_fit_packing(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``with_ids``).

    Null and empty texts are one piece, the end id alone. Only documents longer than the capacity are cut. Repeated
    rows are packed each. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ddl = _PIECES_DDL + (", ids binary" if with_ids else "")
    cut = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = stored(cut.mapInArrow(cut_pieces(capacity, end_id, tokenizer, with_ids), ddl), "pieces")
    # At most ``capacity`` rows reach the driver.
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(bin_completion(counts, capacity))
    # A length may have a third of all rows: rank in salted parts, then add the parts' sizes before it.
    parts = max(64, sum(counts.values()) // 20_000)
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select(
        "length", "part", F.coalesce("before", F.lit(0)).alias("before")
    )
    ranked = (
        salted.join(before, ["length", "part"])
        .withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1 + F.col("before"))
        .drop("part", "before")
    )
    columns = [c for c in pieces.columns]
    spread = spark.sparkContext.broadcast(slots)  # patterns of at most ``capacity`` counts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = spread.value.place(lengths, ranks)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{ddl}, sequence_id long, offset long")


def assemble(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and doc_ids and lengths in order. Needs ``with_ids``."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(ordered.alias("p"))
        .select("sequence_id", F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "").alias("hex"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
        .select("sequence_id", F.unhex("hex").alias("ids"), "doc_ids", "lengths")
    )
