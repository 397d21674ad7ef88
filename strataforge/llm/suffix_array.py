"""Suffix arrays by induced sorting, and common prefixes in text order, in numpy.

The scans of induced sorting take every stretch of entries that are known at once: from the place reached to the first
slot still empty. Each entry is looked at once per scan, as in the plain form, so the work is linear in the text.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol is the smallest and stands there only."""
    step = np.append(np.sign(text[1:].astype(np.int64) - text[:-1]), 1)
    known = np.flatnonzero(step)
    return step[known[np.searchsorted(known, np.arange(len(text)))]] > 0


def _scan(slots: np.ndarray, free: np.ndarray, text: np.ndarray, takes: np.ndarray, forward: bool) -> None:
    """Fill the empty slots (-1): each entry in turn puts the suffix before it, if it is of the type that takes marks, at
    the next free place of its bucket. A backward scan runs over reversed slots, with free counting from there."""
    at, reach, n = 0, 64, len(slots)
    while at < n:
        part = slots[at : at + reach]
        gap = part < 0
        size = int(gap.argmax())
        if not gap[size]:
            size, reach = len(part), min(2 * reach, 1 << 16)
        else:
            reach = max(32, 2 * size)
        before = part[:size] - 1
        before = before[(before >= 0) & takes[before]]
        at += size
        if len(before):
            bucket = text[before]
            order = np.argsort(bucket, kind="stable")
            bucket, before = bucket[order], before[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            times = np.diff(np.append(first, len(bucket)))
            heads = free[bucket[first]]
            slots[np.arange(len(bucket)) + np.repeat(heads - first, times)] = before
            free[bucket[first]] = heads + times


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, n_symbols: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order (seeds, by bucket)."""
    n_large, n_small = np.bincount(text[~small], minlength=n_symbols), np.bincount(text[small], minlength=n_symbols)
    n_seeds = np.bincount(text[seeds], minlength=n_symbols)
    ends = np.cumsum(n_large + n_seeds)
    slots = np.full(int(ends[-1]), -1, np.int64)
    by_bucket = np.cumsum(n_seeds) - n_seeds
    slots[np.arange(len(seeds)) + (ends - n_seeds - by_bucket)[text[seeds]]] = seeds
    free = ends - n_large - n_seeds
    _scan(slots, free, text, ~small, True)
    # the larger ones stand now; the smaller ones are filled from the right
    large = slots[~small[slots]]
    ends = np.cumsum(n_large + n_small)
    full = np.full(len(text), -1, np.int64)
    full[np.arange(len(large)) + (ends - n_large - n_small - (np.cumsum(n_large) - n_large))[text[large]]] = large
    full = full[::-1].copy()
    free = len(text) - ends
    full[free[0]] = len(text) - 1  # the last symbol, alone in the first bucket
    free[0] += 1
    _scan(full, free, text, small, False)
    return full[::-1]


def _names(text: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings, which start at order and are sorted; equal ones share a number."""
    left, right = order[:-1], order[1:]
    same = length[:-1] == length[1:]
    active, at = np.flatnonzero(same), 0
    while len(active):
        equal = text[left[active] + at] == text[right[active] + at]
        same[active[~equal]] = False
        at += 1
        active = active[equal & (length[active] > at)]
    return np.concatenate([[0], np.cumsum(~same)])


def _sort(text: np.ndarray, n_symbols: int) -> np.ndarray:
    small = _types(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(leftmost) == 1:
        return _induce(text, small, leftmost, n_symbols)
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    order = _induce(text, small, leftmost[np.argsort(text[leftmost], kind="stable")], n_symbols)
    order = order[is_leftmost[order]]  # by their substrings
    length = np.ones(len(text), np.int64)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    names = _names(text, order, length[order])
    if names[-1] + 1 < len(names):
        short = np.empty(len(text), np.int64)
        short[order] = names
        order = leftmost[_sort(short[leftmost].astype(np.int32), int(names[-1]) + 1)]
    return _induce(text, small, order, n_symbols)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, for symbols 0 to 254 or, in a wider type, any not too large; empty for no symbols."""
    if not len(text):
        return np.zeros(0, np.int64)
    wide = text.astype(np.uint8 if text.max() < 255 else np.uint16 if text.max() < 65535 else np.int32)
    return _sort(np.append(wide + wide.dtype.type(1), wide.dtype.type(0)), int(text.max()) + 2)[1:]


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of text (bytes), how many symbols its suffix shares with the one before it in order; 0 for the first.

    Only where the symbols before the two suffixes differ is the number found by comparing, eight symbols at a time; from
    there on it falls by one from place to place.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    own = np.arange(n)
    compared = (before <= 0) | (own == 0) | (text[own - 1] != text[np.maximum(before, 1) - 1])
    eight = np.ndarray(n, "<u8", np.concatenate([text, np.zeros(16, np.uint8)]).tobytes(), 0, (1,))
    at, other = own[compared & (before >= 0)], before[compared & (before >= 0)]
    shared, active = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(active):
        i, j = at[active] + shared[active], other[active] + shared[active]
        inside = np.maximum(i, j) < n
        active, i, j = active[inside], i[inside], j[inside]
        x = eight[i] ^ eight[j]
        equal = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
        shared[active] += np.minimum(equal, n - np.maximum(i, j))
        active = active[x == 0]
    reach = np.zeros(n, np.int64)
    reach[at] = shared + at
    return np.maximum(np.maximum.accumulate(reach) - own, 0)
