from __future__ import annotations

import random

import numpy as np

from postmill.llm.suffixes import byte_keys, common_prefixes, suffix_array


def test_against_sorted_suffixes():
    rng = random.Random(1)
    for _ in range(150):
        segments = [bytes(rng.choices(b"ab", k=rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        data = b"".join(segments)
        view = np.frombuffer(data, np.uint8)
        order = suffix_array(byte_keys(view), 8, len(data) + 8)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        ends = np.cumsum([len(s) for s in segments])
        starts = ends - [len(s) for s in segments]
        shared = common_prefixes(view, order, starts, ends, 20)
        for k in range(1, len(order)):
            i, j = int(order[k]), int(order[k - 1])
            most, same = min(len(data) - max(i, j), 20), 0
            while same < most and data[i + same] == data[j + same]:
                same += 1
            assert shared[k] == same


def test_words_and_empty():
    assert len(suffix_array(np.zeros(0, np.uint64), 1, 8)) == 0
    symbols = np.array([3, 1, 2, 1, 2, 3], np.uint64)
    order = suffix_array(symbols, 1, 8)
    assert order.tolist() == sorted(range(6), key=lambda i: symbols[i:].tolist())
