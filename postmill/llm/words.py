"""Words of UTF-8 text as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np

#: Lower-cases A-Z; 0 for every byte that is no part of a word.  Words are runs of
#: ASCII letters, digits and all characters beyond ASCII.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _low, _high, _to in ((0x30, 0x3A, 0x30), (0x41, 0x5B, 0x61), (0x61, 0x7B, 0x61)):
    _FOLD[_low:_high] = np.arange(_to, _to + _high - _low)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 8)] + [(1 << 64) - 1], np.uint64)


def fold(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def word_spans(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and how many words each text has."""
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(folded))]
    begins[cuts] |= inside[cuts]  # a text begins where the one before it may end in a word
    ends[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    return starts, stops, np.diff(np.searchsorted(starts, offsets))


def word_numbers(folded: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number above 0 for each word, equal for equal words.

    Different words of up to eight bytes never share a number; longer ones do with
    a probability of 2**-64.
    """
    padded = np.zeros(len(folded) + 8, np.uint8)
    padded[: len(folded)] = folded
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)
    lengths = stops - starts
    out = np.zeros(len(starts), np.uint64)
    active, done = np.arange(len(starts)), 0
    while len(active):
        left = lengths[active] - done
        chunk = np.ascontiguousarray(view[starts[active] + done]).view(np.uint64).ravel()
        chunk &= _MASKS[np.minimum(left, 8)]
        value = (out[active] ^ chunk) * _MIX
        out[active] = value ^ (value >> np.uint64(29))
        done += 8
        active = active[left > 8]
    out[out == 0] = 1
    return out
