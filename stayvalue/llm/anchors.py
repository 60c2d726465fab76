"""Content-defined anchors: equal stretches of bytes have equal anchors at equal places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes of a stretch, and of the gram that anchors it.
STRETCH = 200
GRAM = 64
#: Stretches that are looked at together; only memory depends on it.
CHUNK = 1 << 18

_PLACE_BITS = 20
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SIZE = CHUNK + STRETCH
_UP = _powers(_BASE, _SIZE)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _SIZE)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place, from differences of prefix sums mod 2^64."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    hashed = (sums[GRAM:] - sums[:-GRAM]) * _DOWN[: len(data) - GRAM + 1]
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(32)
    return hashed


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(gram, place, first, last): runs of stretch starts with one anchor, in order.

    The anchor of a stretch is its gram of smallest hash, the last such. Stretches ``first`` to
    ``last`` (starts, inclusive) share the anchor at ``place``. A long text comes in chunks, at whose
    borders a run may be cut in two.
    """
    for begin in range(0, len(text) - STRETCH + 1, CHUNK):
        data = np.frombuffer(text[begin : begin + CHUNK + STRETCH - 1], dtype=np.uint8)
        hashes = gram_hashes(data)
        order = (hashes & ~_PLACES) | (
            _PLACES - np.arange(len(hashes), dtype=np.uint64)
        )
        least = _window_minimum(order, STRETCH - GRAM + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        last = np.append(first[1:] - 1, len(least) - 1)
        place = (_PLACES - (least[first] & _PLACES)).astype(np.int64)
        yield hashes[place].view(np.int64), place + begin, first + begin, last + begin


def context_hash(text: bytes, first: int, last: int) -> int:
    """A hash of all bytes that the stretches from ``first`` to ``last`` cover, as a signed long."""
    value = xxhash.xxh3_64_intdigest(text[first : last + STRETCH], seed=last - first)
    return value - (1 << 64) if value >= 1 << 63 else value
