"""Content-defined anchors: where equal byte strings meet, wherever they stand.

Every window of ``width`` bytes has an anchor, the place of the smallest hash among its
``GRAM``-byte strings (the leftmost of equals). It depends on the window's bytes alone, so
equal windows have equal anchors at equal offsets. Consecutive windows of a document with
the same anchor form one run.
"""

from __future__ import annotations

import numpy as np

#: Bytes of the strings that are hashed; a power of two.
GRAM = 32
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)


_FIRST, _SECOND, _THIRD = _byte_values(1), _byte_values(2), _byte_values(3)
_BASE, _BASE_TWO = 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place, by doubling."""
    h, n = _FIRST[text], 1
    for m in _MULTIPLIERS:
        h = h[:-n] * np.uint64(m) + (h[n:] ^ (h[n:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        n *= 2
    return h


def range_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range, folded from two polynomials."""
    out = []
    for table, base in ((_SECOND, _BASE), (_THIRD, _BASE_TWO)):
        power = np.full(len(text) + 1, base, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(table[text] * power[:-1], out=sums[1:])
        inverse = np.full(len(text) + 1, pow(base, -1, 2**64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        out.append((sums[ends] - sums[starts]) * inverse[starts])
    one, two = out
    two = two * np.uint64(0x9E3779B97F4A7C15)
    return one ^ (two >> np.uint64(31)) ^ (two << np.uint64(33)) ^ (ends - starts).astype(np.uint64)


def _window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    low, n = keys, 1
    while 2 * n <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    rest = width - n
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def runs(text: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of windows over documents laid one after another, each ending at one of ``ends``.

    Returns the document, the first window's place in ``text``, the number of windows, and
    the hashes of the anchor's bytes and of the run's whole range.
    """
    none = np.zeros(0, np.int64)
    if len(text) < width:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = gram_hashes(text)
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_window_min(keys, width - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    place = np.arange(len(anchor))
    doc = np.searchsorted(ends, place, side="right")
    inside = place + width <= ends[np.minimum(doc, len(ends) - 1)]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.add.reduceat(inside.astype(np.int64), first)  # windows past the document's end come last
    first, count = first[count > 0], count[count > 0]
    return doc[first], first, count, grams[anchor[first]], range_hashes(text, first, first + count + width - 1)
