"""Repeated passages by sparse suffix arrays.

Suffixes are kept at content-selected minimiser places only (the anchors of ``repeats``). The suffixes at equal minimisers
are sorted by their words and compared with their neighbours in that order; a match is extended to the right by the common
prefix and to the left by the common words before the minimiser.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Repeat, Segment, remove_repeats, runs_of

#: Passages of over 50 words, that is 51 or more; any such passage has a minimiser of 16 words.
LENGTH, GRAM = 51, 16
#: Minimisers with more occurrences are compared by whole windows.
HOT = 64


def common(a: Sequence[bytes], b: Sequence[bytes]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compare_sorted(segments: Iterator[Segment], length: int) -> Iterator[Repeat]:
    # Of equal segments the first stands for all in the array; the others repeat it wholly and aren't held.
    first: dict[tuple[bytes, int], tuple[int, int]] = {}
    kept = []
    for doc, uid, start, count, at, text in segments:
        place = (doc, start)
        known = first.get((text, at))
        if known is None:
            first[text, at] = place
            kept.append((place, uid, count, at, text.split()))
        elif known != place:
            yield doc, uid, start, count
    kept.sort(key=lambda s: s[4][s[3] :])
    suffixes, lefts = [s[4][s[3] :] for s in kept], [s[4][: s[3]][::-1] for s in kept]
    flags = [np.zeros(s[2], bool) for s in kept]
    for i in range(len(kept)):
        right = len(suffixes[i])
        for j in range(i + 1, len(kept)):
            # The order makes the common prefix with i only shorter from neighbour to neighbour.
            right = min(right, common(suffixes[j - 1], suffixes[j]))
            if right + len(lefts[i]) < length:
                break
            left = common(lefts[i], lefts[j])
            if left + right >= length and kept[i][0] != kept[j][0]:
                later = i if kept[i][0] > kept[j][0] else j
                begin = kept[later][3] - left
                flags[later][max(0, begin) : max(0, begin + left + right - length + 1)] = True
    for (place, uid, _, _, _), own in zip(kept, flags, strict=True):
        for a, n in runs_of(own):
            yield place[0], uid, place[1] + a, n


def suffix_array_dedup(docs: DataFrame, length: int = LENGTH, **columns: str) -> DataFrame:
    """Removes passages of ``length`` words or more that occur earlier. See ``remove_repeats``."""
    return remove_repeats(docs, length, min(GRAM, length), compare_sorted, hot=HOT, **columns)
