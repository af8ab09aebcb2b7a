"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai common prefixes, binary search.

A sequence is any array of symbols; ``keys`` orders its suffixes by their first
``width`` symbols.  Sequences are small shards, never a whole corpus.
"""

from __future__ import annotations

import numpy as np


def suffix_array(keys: np.ndarray, width: int, depth: int) -> np.ndarray:
    """Places of all suffixes, ordered by their first ``depth`` symbols at least.

    Groups of suffixes that agree so far are refined by the rank of what follows
    them, at twice the distance each time; finished groups are not touched again.
    Suffixes that agree to the depth stay in the order of their places.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    if not n:
        return order
    sorted_keys = keys[order]
    head = np.ones(n, bool)
    head[1:] = sorted_keys[1:] != sorted_keys[:-1]
    del sorted_keys
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    open_at = np.arange(n)
    while width < depth:
        alone = head[open_at] & head[np.minimum(open_at + 1, n - 1)]
        if open_at[-1] == n - 1:
            alone[-1] = head[n - 1]
        open_at = open_at[~alone]
        if not len(open_at):
            break
        place = order[open_at]
        after = place + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = group[open_at]
        mixed = first * (n + 1) + second + 1
        by = np.argsort(mixed, kind="stable")
        place, mixed = place[by], mixed[by]
        order[open_at] = place
        head[open_at[1:]] |= mixed[1:] != mixed[:-1]
        new = np.maximum.accumulate(np.where(head[open_at], open_at, 0))
        group[open_at] = new
        rank[place] = new
        width *= 2
    return order


def byte_keys(data: np.ndarray) -> np.ndarray:
    """For each place, its eight bytes as one number in their order; zeros beyond the end."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out <<= np.uint64(8)
        out |= padded[i : i + n]
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """For each place in ``order``, the bytes it shares with its predecessor, up to ``most``.

    Kasai's rule: the suffix one byte further shares at most one byte less, so a
    stretch of text (``starts`` to ``ends``) is walked in text order with a running
    length.  All stretches walk in step, one lane each.  They must cover ``data``, and
    ``order`` must be sorted to the end: the rule does not hold among suffixes that
    are left in the order of their places.
    """
    n = len(data)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    words = byte_keys(data)
    shared = np.zeros(n, np.int64)
    lanes = np.argsort(starts - ends, kind="stable")  # longest first, so that finished lanes are a tail
    starts, ends = starts[lanes], ends[lanes]
    lengths = ends - starts
    running = np.zeros(len(starts), np.int64)
    alive = len(starts)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        while alive and lengths[alive - 1] <= step:
            alive -= 1
        at = starts[:alive] + step
        place = rank[at]
        before = order[np.maximum(place - 1, 0)]
        bound = np.minimum(n - np.maximum(at, before), most)
        bound[place == 0] = 0
        length = np.minimum(np.maximum(running[:alive] - 1, 0), bound)
        moving = np.flatnonzero(length < bound)
        while len(moving):
            a, b = at[moving] + length[moving], before[moving] + length[moving]
            differ = words[a] ^ words[b]
            same = np.where(differ == 0, 8, _leading_equal(differ))
            length[moving] = np.minimum(length[moving] + same, bound[moving])
            moving = moving[(differ == 0) & (length[moving] < bound[moving])]
        running[:alive] = length
        shared[place] = length
    return shared


def _leading_equal(differ: np.ndarray) -> np.ndarray:
    """Equal leading bytes of two eight-byte numbers, from their difference."""
    out = np.zeros(len(differ), np.int64)
    left = differ.copy()
    for bits, count in ((32, 4), (16, 2), (8, 1)):
        zero = (left >> np.uint64(64 - bits)) == 0
        out[zero] += count
        left[zero] <<= np.uint64(bits)
    return out


def narrow(
    symbols: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of many patterns at once: one more symbol.

    ``low`` to ``high`` are the places in ``order`` whose suffixes match a pattern so
    far, to ``depth`` symbols; the result are those whose next symbol is ``wanted``.
    """
    return _bisect(symbols, order, low, high, depth, wanted, False), _bisect(
        symbols, order, low, high, depth, wanted, True
    )


def _bisect(symbols, order, low, high, depth, wanted, after):
    low, high = low.copy(), high.copy()
    n = len(symbols)
    while True:
        open_at = np.flatnonzero(low < high)
        if not len(open_at):
            return low
        middle = (low[open_at] + high[open_at]) // 2
        at = order[middle] + depth
        # A suffix that ends before the symbol comes first; 0 is no pattern's symbol.
        symbol = np.where(at < n, symbols[np.minimum(at, n - 1)], 0)
        right = symbol <= wanted[open_at] if after else symbol < wanted[open_at]
        low[open_at[right]] = middle[right] + 1
        high[open_at[~right]] = middle[~right]
