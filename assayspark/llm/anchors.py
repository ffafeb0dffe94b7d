"""Anchors of byte windows: content-defined places that equal windows share.

The anchor of a window of LENGTH bytes is its gram of GRAM bytes with the smallest hash, the leftmost of
equals. Neighbouring windows mostly share their anchor, so a text has one anchor for about every 17 bytes, and
the windows of one anchor are a stretch of neighbouring starts. Equal windows have equal anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from assayspark.llm.shingles import mix

LENGTH = 50
GRAM = 18
#: Bytes handled at once; longer texts are taken in overlapping parts.
PART = 1 << 18
#: Bytes of shorter texts that are handled together.
JOINED = 1 << 15
_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE_BITS = 24
_cache: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _cache.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, PART + 2 * LENGTH), base, dtype=np.uint64)
        steps[0] = 1
        known = _cache[base] = np.multiply.accumulate(steps)
    return known[:n]


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=out[1:])
    return out


def _hashes(sums: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Hash of the bytes from each start, of the given length."""
    return (sums[starts + lengths] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]


def _every_hash(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of the bytes of this length from every start."""
    n = len(sums) - length
    return (sums[length:] - sums[:n]) * _powers(_INVERSE, n)


def window_hashes(data: np.ndarray, salt: int) -> np.ndarray:
    """Hash of every window."""
    return mix(_every_hash(_sums(data), LENGTH), salt)


def _least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def text_anchors(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hash of the anchor, hash of all bytes its windows cover, first window, and a shape.

    The shape is 64 times the anchor's distance from the first window, plus the number of windows less one.
    """
    for at in range(0, max(1, len(data) - LENGTH + 1), PART):
        part = data[at:at + PART + LENGTH - 1]
        if len(part) < LENGTH:
            return
        anchor, cover, first, shape = _anchors_of(part, np.arange(len(part) - LENGTH + 1))
        yield anchor, cover, first + at, shape


def joined_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place of the text and what ``text_anchors`` gives, for texts that are a part together."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - LENGTH + 1, 0))
    counts = np.maximum(sizes - LENGTH + 1, 0)
    starts = np.arange(len(owner)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    anchor, cover, first, shape = _anchors_of(np.frombuffer(b"".join(texts), dtype=np.uint8), starts)
    text = np.searchsorted(begins, first, side="right") - 1
    return text, anchor, cover, first - begins[text], shape


def _anchors_of(part: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows at these starts; two windows of one anchor have all starts between them."""
    sums = _sums(part)
    grams = mix(_every_hash(sums, GRAM), 3)
    place = np.arange(len(grams), dtype=np.uint64)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    best = (_least_in_window((grams & ~mask) | place, LENGTH - GRAM + 1) & mask)[starts]
    edge = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    first = starts[edge]
    extra = np.diff(np.append(edge, len(best))) - 1
    cover = mix(_hashes(sums, first, extra + LENGTH) ^ (extra.astype(np.uint64) << np.uint64(57)), 4)
    place = best[edge].astype(np.int64)
    return grams[place], cover, first, (place - first) * 64 + extra
