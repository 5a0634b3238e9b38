"""Substring dedup by suffix automata of reference shards.

A shard is what the corpus has at one anchor (see ``repeats``): small, and next to every text that could match it, so each
text is streamed through its own shards only. Broadcasting automata of the whole corpus instead would stream every document
through every shard, work that grows with the square of the corpus. ``against_reference`` broadcasts, for references of a
checked size.

A shard's segments come in document order. Each is streamed through the automaton of those before it; where the
matching statistic, the length of the longest earlier match that ends at a word, reaches the threshold, the window that
ends there has occurred earlier. Then the segment joins the automaton.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of
from .repeats import Repeat, Segment, remove_repeats, runs_of

LENGTH, GRAM = 20, 6
#: The most words a broadcast reference may have; an automaton has at most two states a word.
REFERENCE_WORDS = 200_000


class SuffixAutomaton:
    """Of several word sequences; grows online, in amortised constant time a word."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: Iterable[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _extend(self, last: int, word: bytes) -> int:
        nexts, link, length = self.next, self.link, self.length
        there = nexts[last].get(word)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, word, there)
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in nexts[at]:
            nexts[at][word] = new
            at = link[at]
        if at >= 0:
            there = nexts[at][word]
            link[new] = there if length[there] == length[at] + 1 else self._split(at, word, there)
        return new

    def _split(self, at: int, word: bytes, there: int) -> int:
        clone = len(self.next)
        self.next.append(self.next[there].copy())
        self.link.append(self.link[there])
        self.length.append(self.length[at] + 1)
        self.link[there] = clone
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def statistics(self, words: Sequence[bytes]) -> list[int]:
        """For every word, how many words up to it are the longest match that ends there."""
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for word in words:
            to = nexts[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nexts[state].get(word)
            if to is None:
                matched = 0
            else:
                state, matched = to, matched + 1
            out.append(matched)
        return out


def compare_streamed(segments: Iterator[Segment], length: int) -> Iterator[Repeat]:
    automaton, before, first = None, None, None
    for doc, uid, start, count, _, text in segments:
        if before is None:
            before = first = (doc, start, text)
            continue
        if (doc, start, text) == before:
            continue  # a repeated row
        before = (doc, start, text)
        words = text.split()
        if automaton is None:
            automaton = SuffixAutomaton()
            automaton.add(first[2].split())
        flags = np.array(automaton.statistics(words)[length - 1 :]) >= length
        for a, n in runs_of(flags):
            yield doc, uid, start + a, n
        if not flags.all():
            automaton.add(words)


def substring_dedup(docs: DataFrame, length: int = LENGTH, **columns: str) -> DataFrame:
    """Removes every word covered by a window of ``length`` words that occurs earlier. See ``remove_repeats``."""
    return remove_repeats(docs, length, min(GRAM, length), compare_streamed, **columns)


def against_reference(docs: DataFrame, reference: DataFrame, length: int = LENGTH, most_words: int = REFERENCE_WORDS) -> DataFrame:
    """Maximal spans of ``docs`` that match ``reference`` texts on ``length`` words or more, by broadcast automata.

    Returns doc_id, start, end (words, end exclusive). A reference of more than ``most_words`` words is refused.
    """
    from .common import WORD_GAP

    size = reference.agg(F.sum(F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), WORD_GAP)))).first()[0] or 0
    if size > most_words:
        raise ValueError(f"the reference has {size} words, {most_words} are the bound for a broadcast")
    texts = [(r["text"] or "").encode() for r in reference.select("text").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(texts)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton()
        for text in shared.value:
            automaton.add(text.split())
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for low, some in texts_of(batch, "text"):
                for row, text in enumerate(some, low):
                    stats = np.array(automaton.statistics(text.split())[length - 1 :]) >= length
                    rows += [(ids[row], a, a + n + length - 1) for a, n in runs_of(stats)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "end"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(match, "doc_id long, start long, end long")
