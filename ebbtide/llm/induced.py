"""External induced sorting of suffixes, with bulk priority queues that spill to disk.

The suffixes of a text are sorted by their types. A suffix is of type S if it is smaller
than the one after it, else L; an S after an L is an LMS suffix. From the sorted LMS
suffixes one sweep upwards induces the order of all L suffixes, and one downwards that of
all S suffixes: whenever a suffix leaves the queue, the one before it in the text enters
with its own first character. The LMS suffixes are sorted by recursion: a sweep over the
unsorted ones sorts the LMS substrings, their ranks form a text a third as long, and its
suffixes are sorted in the same way.

The queue holds tuples (key, place) in sorted runs that are merged as they grow, and keeps
runs of more than ``IN_MEMORY`` tuples in files. Tuples leave in batches: as many at once
as cannot be preceded by anything they induce.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Tuples of a queue's run kept in memory; longer runs go to temporary files.
IN_MEMORY = 1 << 20
#: Most tuples taken in one step.
BATCH = 1 << 15


class BulkQueue:
    """A priority queue of (key, place), both 64-bit, that takes and gives arrays."""

    def __init__(self, folder: str):
        self.folder = folder
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def _kept(self, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(keys) <= IN_MEMORY:
            return keys, places
        out = []
        for part in (keys, places):
            with tempfile.TemporaryFile(dir=self.folder) as f:  # the mapping keeps the file's data until it is dropped
                part.tofile(f)
                f.flush()
                out.append(np.memmap(f, part.dtype, "r"))
        return out[0], out[1]

    def push(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Add tuples sorted by key."""
        while len(keys):
            if not self.runs or len(self.runs[-1][0]) > 2 * len(keys):
                self.runs.append(self._kept(keys, places))
                return
            other = self.runs.pop()
            keys, places = merged([(keys, places), other])

    def peek(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The smallest tuples, ``most`` at most, in order; they stay in the queue."""
        return tuple(x[:most] for x in merged([(k[:most], p[:most]) for k, p in self.runs]))

    def drop(self, last: int) -> None:
        """Remove all tuples with keys up to ``last``."""
        cut = [(k, p, int(np.searchsorted(k, last, side="right"))) for k, p in self.runs]
        self.runs = [(k[n:], p[n:]) for k, p, n in cut if n < len(k)]

    def __bool__(self) -> bool:
        return bool(self.runs)


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs as one."""
    if len(runs) == 1:
        return runs[0]
    keys = np.concatenate([k for k, _ in runs])
    order = np.argsort(keys, kind="stable")  # merges sorted stretches
    return keys[order], np.concatenate([p for _, p in runs])[order]


def _induce(chars: np.ndarray, kind: np.ndarray, sources: np.ndarray, folder: str) -> np.ndarray:
    """Places of the suffixes with ``kind`` in order, induced from ``sources`` in order.

    Keys order by character, then induced before sources, then by time of entry.
    """
    queue = BulkQueue(folder)
    key = (chars[sources].astype(np.int64) << 33) | (1 << 32)
    order = np.argsort(key, kind="stable")
    queue.push(key[order] + np.arange(len(sources)), sources[order])
    out, entered = [], 0
    size = 256
    while queue:
        keys, places = queue.peek(size)
        before = places - 1
        induces = before >= 0
        induces[induces] = kind[before[induces]]
        new = np.where(induces, chars[np.maximum(before, 0)].astype(np.int64) << 33, np.int64(2**62))
        new[induces] += entered + np.arange(int(induces.sum()))
        least = np.minimum.accumulate(new)
        late = np.flatnonzero(keys[1:] > least[:-1])
        n = int(late[0]) + 1 if len(late) else len(keys)
        size = min(BATCH, max(64, 2 * n))
        queue.drop(keys[n - 1])
        own = (keys[:n] >> 32 & 1) == 0
        out.append(places[:n][own])
        new, before = new[:n][induces[:n]], before[:n][induces[:n]]
        entered += len(new)
        order = np.argsort(new, kind="stable")
        queue.push(new[order], before[order])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _both_sweeps(chars: np.ndarray, is_s: np.ndarray, lms: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """L suffixes and S suffixes in order, from LMS suffixes in order."""
    end = np.array([len(chars) - 1])
    large = _induce(chars, ~is_s, np.concatenate([end, lms[lms != end[0]]]), folder)
    flipped = chars.max() - chars
    small = _induce(flipped, is_s, large[::-1].copy(), folder)[::-1]
    return large, small


def suffix_order(chars: np.ndarray, folder: str) -> np.ndarray:
    """Places of all suffixes in lexicographic order.

    ``chars`` are integers from 0; the last one is 0 and the only 0.
    """
    n = len(chars)
    if n == 1:
        return np.zeros(1, np.int64)
    # Types from the right: equal characters have the type of the next different one.
    change = np.flatnonzero(chars[:-1] != chars[1:])
    smaller = chars[change] < chars[change + 1]
    is_s = np.ones(n, bool)
    is_s[:-1] = smaller[np.searchsorted(change, np.arange(n - 1))]
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    # Sort the LMS substrings: sweep over the LMS suffixes in any order within a character.
    _, small = _both_sweeps(chars, is_s, lms, folder)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = np.concatenate([[n - 1], small[is_lms[small] & (small != n - 1)]])
    number = np.cumsum(is_lms) - 1
    length = np.append(np.diff(lms), 1)[number[by_substring]] + 1
    same = length[1:] == length[:-1]
    for k in range(int(length.max())):
        rows = np.flatnonzero(same & (length[1:] > k))
        if not len(rows):
            break
        one, two = by_substring[rows] + k, by_substring[rows + 1] + k
        same[rows[(one >= n) | (two >= n)]] = False
        fits = (one < n) & (two < n)
        same[rows[fits]] = chars[one[fits]] == chars[two[fits]]
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.zeros(len(lms), np.int64)
    names[number[by_substring]] = rank
    if rank[-1] + 1 == len(lms):
        order = by_substring
    else:
        order = lms[suffix_order(names, folder)]
    large, small = _both_sweeps(chars, is_s, order, folder)
    small = np.concatenate([[n - 1], small[small != n - 1]])
    places = np.concatenate([large, small])
    key = chars[places].astype(np.int64) * 2 + is_s[places]
    return places[np.argsort(key, kind="stable")]


def shared_prefix_at_least(text: np.ndarray, one: np.ndarray, two: np.ndarray, width: int) -> np.ndarray:
    """Whether suffixes share their first ``width`` characters; both lie ``width`` before the end."""
    same = np.ones(len(one), bool)
    for k in range(width):
        rows = np.flatnonzero(same)
        if not len(rows):
            break
        same[rows] = text[one[rows] + k] == text[two[rows] + k]
    return same
