"""Anchors of byte strings: the places that every long enough repeat must share.

Of the K-byte grams in a window the one with the least hash is the window's
anchor (the leftmost of equals). Equal windows have their anchors at equal
places, so two places of a text hold the same LENGTH bytes only if their windows'
anchors hold the same gram. Consecutive windows with one anchor form a stretch:
the bytes that they cover together.
"""

from __future__ import annotations

import numpy as np

from ratecast.llm.bytes_hash import Substrings

PART = 1 << 19


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, start, end, anchor, gram's hash) of every stretch of a block of texts; places count in the block."""
    h = Substrings(data)
    found: list[tuple[np.ndarray, ...]] = []
    last = len(data) - length + 1
    if last <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64)
    owner_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    for lo in range(0, last, PART):
        hi = min(lo + PART, last)  # windows that start in [lo, hi)
        at = np.arange(lo, hi + length - gram)
        # the gram's hash, its low bits the place: equal hashes keep their order
        key = (h(at, at + gram) >> np.uint64(20) << np.uint64(20)) | (at - lo).astype(np.uint64)
        width, least = 1, key
        while 2 * width <= length - gram + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = length - gram + 1 - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least[:hi - lo] & np.uint64((1 << 20) - 1)).astype(np.int64) + lo
        window = np.arange(lo, hi)
        text = owner_of(window)
        inside = window + length < offsets[text + 1]  # the byte that ends a text is in no window
        change = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
        for_run = np.add.reduceat(inside.astype(np.int64), change)
        keep = for_run > 0  # windows inside come first in a run
        start = window[change][keep]
        found.append((text[change][keep], start, start + for_run[keep] - 1 + length, anchor[change][keep]))
    text, start, end, anchor = (np.concatenate(c) for c in zip(*found))
    # a run that a part's end cut in two is one stretch
    joined = np.concatenate(([False], (anchor[1:] == anchor[:-1]) & (text[1:] == text[:-1]) & (end[:-1] - length + 1 == start[1:])))
    if joined.any():
        first = np.flatnonzero(~joined)
        end = np.maximum.reduceat(end, first)
        text, start, anchor = text[first], start[first], anchor[first]
    return text, start, end, anchor, h(anchor, anchor + gram)
