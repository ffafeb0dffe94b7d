"""Simple-8b word-aligned coding of non-negative integers, as numpy arrays.

A 64-bit word has a 4-bit selector on top and 60 bits of equally wide values below, the first value
lowest. Selector 0 stands for a run of 240 zeros. Selector 1 is an escape: the value follows as a
whole raw word, for values that need more than 60 bits. A block of bytes holds

    magic "S8B1", then unsigned 32-bit: values, words, escapes, groups
    unsigned 32-bit: for each group of GROUP words, the index of its first value
    unsigned 32-bit: places of the escapes' raw words
    64-bit words, all little-endian

so that a reader can start at any group, and can decode all words of one selector at once.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: selector -> (values in a word, bits of a value).
SELECTORS = {
    2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7), 9: (7, 8), 10: (6, 10),
    11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60),
}
ZEROS = 240
MAGIC = b"S8B1"
GROUP = 256
_COUNTS = np.array([ZEROS, 1] + [SELECTORS[s][0] for s in range(2, 16)], dtype=np.int64)


def _runs(fits: np.ndarray, count: int) -> np.ndarray:
    """Whether ``count`` elements in a row fit, for each place that has as many from it on."""
    length = 1
    while 2 * length <= count:
        fits = fits[:-length] & fits[length:]
        length *= 2
    return fits[:length - count] & fits[count - length:] if length < count else fits


def _selectors_at(values: np.ndarray) -> np.ndarray:
    """The selector a word would take if it began at each value: the one that holds most values.

    A word at the end may hold fewer; its other places stay 0.
    """
    best = np.ones(len(values), dtype=np.int8)
    for selector, (count, bits) in sorted(SELECTORS.items(), reverse=True):
        narrow = np.ones(len(values) + count - 1, dtype=bool)
        np.less(values, np.uint64(1 << bits), out=narrow[:len(values)])
        fits = _runs(narrow, count)
        if not fits.any():
            break
        np.copyto(best, np.int8(selector), where=fits)
    zeros = _runs(values == 0, ZEROS)
    best[:len(zeros)][zeros] = 0
    return best


def encode(values: np.ndarray) -> bytes:
    """One block for the values; an empty array gives a block without words."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    best = _selectors_at(values)
    steps = _COUNTS[best].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = best[starts] if n else starts
    escaped = chosen == 1
    place = np.arange(len(starts)) + np.cumsum(escaped) - escaped
    words = np.zeros(len(starts) + int(escaped.sum()), dtype=np.uint64)
    padded = np.concatenate([values, np.zeros(ZEROS, dtype=np.uint64)])
    for selector, (count, bits) in SELECTORS.items():
        own = chosen == selector
        if own.any():
            taken = padded[starts[own][:, None] + np.arange(count)]
            shifted = taken << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[place[own]] = np.bitwise_or.reduce(shifted, axis=1) | np.uint64(selector << 60)
    words[place[escaped]] = np.uint64(1 << 60)
    words[place[escaped] + 1] = values[starts[escaped]]
    raw = (place[escaped] + 1).astype("<u4")
    first = np.zeros(len(words), dtype=np.int64)
    first[place] = starts
    first[raw] = starts[escaped]
    groups = first[::GROUP].astype("<u4")
    head = np.array([n, len(words), len(raw), len(groups)], dtype="<u4")
    return MAGIC + head.tobytes() + groups.tobytes() + raw.tobytes() + words.astype("<u8").tobytes()


def decode(block: bytes) -> np.ndarray:
    """All values of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a Simple-8b block")
    n, n_words, n_raw, n_groups = np.frombuffer(block, "<u4", 4, 4).tolist()
    at = 20 + 4 * n_groups
    raw = np.frombuffer(block, "<u4", n_raw, at).astype(np.int64)
    words = np.frombuffer(block, "<u8", n_words, at + 4 * n_raw)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selector]
    counts[raw] = 0
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) + ZEROS, dtype=np.uint64)
    coded = np.ones(n_words, dtype=bool)
    coded[raw] = False
    for kind, (count, bits) in SELECTORS.items():
        own = coded & (selector == kind)
        if own.any():
            shift = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            mask = np.uint64((1 << bits) - 1)
            out[starts[own][:, None] + np.arange(count)] = (words[own][:, None] >> shift) & mask
    out[starts[raw - 1]] = words[raw]
    return out[:n]
