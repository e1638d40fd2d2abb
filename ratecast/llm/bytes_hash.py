"""Hashes of many substrings of many texts at once, in numpy.

Texts are laid end to end as UTF-8 bytes. With a running sum of byte values
times the powers of an odd number, the hash of any substring is one difference
and one product (modulo 2**64), so all words, n-grams or windows of a batch
are hashed without a loop over them. ``mix`` spreads the result over all bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)
BLOCK_BYTES = 1 << 21

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, kept for the next batch."""
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, b in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Substrings:
    """Hashes of substrings ``data[start:end]``; ``seed`` gives an independent second hash."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down = powers(len(data) + 1)
        values = data.astype(np.uint64) + np.uint64(1)
        if seed:
            values = mix(values * np.uint64(2 * seed + 1))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * up[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def blocks(texts: Iterable[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive texts laid end to end: (index of the first, bytes, offsets), about ``limit`` bytes each.

    A text longer than the limit is a block of its own, whole. One zero byte
    follows every text.
    """
    part: list[bytes] = []
    first = size = 0
    for t in texts:
        if part and size + len(t) > limit:
            yield first, *_joined(part)
            first, part, size = first + len(part), [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield first, *_joined(part)


def _joined(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(part) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in part], out=offsets[1:])
    return np.frombuffer(b"\0".join(part) + b"\0", np.uint8), offsets


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def distinct_by_text(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (owner, value) pairs, sorted."""
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    if not len(o):
        return o, v
    keep = np.concatenate(([True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])))
    return o[keep], v[keep]
