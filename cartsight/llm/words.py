"""Words of many texts at once, as hashes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
PIECE = 1 << 20  # bytes hashed at a time


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes: numbers of its bytes times the powers of a base, from running sums.

    Stretches come in order, none is empty, and none overlap.
    """
    out = np.empty(len(starts), np.uint64)
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(stops, starts[a] + PIECE, "right")))
        low, high = int(starts[a]), int(stops[b - 1])
        power = np.full(high - low, base)
        power[0] = 1
        sums = np.cumsum(_BYTES[data[low:high]] * np.cumprod(power))
        power[1:] = inverse
        back = np.cumprod(power)
        at, last = starts[a:b] - low, stops[a:b] - low - 1
        before = np.where(at > 0, sums[at - 1], np.uint64(0))
        h = (sums[last] - before) * back[at]
        h = (h ^ (h >> np.uint64(32))) * base
        out[a:b] = h ^ (h >> np.uint64(29))
        a = b
    return out


def hashed_words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z lowered, between characters of white space, and how many each text has."""
    lowered = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join([*lowered, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.diff(space, prepend=True)
    starts, stops = np.flatnonzero(edge & ~space), np.flatnonzero(edge & space)
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    return span_hashes(data, starts, stops), np.diff(np.searchsorted(starts, ends), prepend=0)
