"""Suffix array by Lyndon grouping.

Suffixes that share their Lyndon prefix form a group; the groups' order is that of the prefixes. A suffix
without its Lyndon prefix is its next smaller suffix, so inside a group the order is that of smaller suffixes,
which come earlier: one pass over the array in order fills every group from left to right.
"""

from __future__ import annotations

from collections import Counter

import numpy as np


def _leading(text: bytes) -> list[int]:
    """Rank of the first eight bytes of each suffix, as if zeros followed the text."""
    data = np.frombuffer(text + bytes(7), dtype=np.uint8)
    keys = np.zeros(len(text), dtype=np.uint64)
    for place in range(8):
        keys = (keys << np.uint64(8)) | data[place:place + len(text)]
    return np.unique(keys, return_inverse=True)[1].tolist()


def suffix_array(text: bytes) -> list[int]:
    """Starts of all suffixes in lexicographic order."""
    n = len(text)
    rank = _leading(text)
    following = [n] * n
    for start in range(n - 1, -1, -1):
        end, own = start + 1, rank[start]
        # Lyndon prefixes are compared only where the first bytes do not tell.
        while end < n and (own < rank[end] or own == rank[end] and text[start:end] < text[end:following[end]]):
            end = following[end]
        following[start] = end
    prefixes = [text[a:b] for a, b in enumerate(following)]
    sizes = Counter(prefixes)
    number = {prefix: k for k, prefix in enumerate(sorted(sizes))}
    group = [number[prefix] for prefix in prefixes]
    counts = np.bincount(np.array(group, dtype=np.int64), minlength=1)
    free = (np.cumsum(counts) - counts).tolist()
    # The suffixes with one next smaller suffix, from right to left.
    ends = np.array(following, dtype=np.int64)
    by_end = (n - 1 - np.argsort(ends[::-1], kind="stable")).tolist()
    first = np.searchsorted(np.sort(ends), np.arange(n + 2)).tolist()
    order = [0] * n
    at, smaller = -1, n
    while True:
        for start in by_end[first[smaller]:first[smaller + 1]]:
            place = group[start]
            order[free[place]] = start
            free[place] += 1
        at += 1
        if at >= n:
            return order
        smaller = order[at]
