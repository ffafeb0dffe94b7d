"""Word shingles of whole texts as 64-bit hashes, many documents at a time in numpy.

A-Z count as a-z, a word is a run without ASCII white space, and a text's set holds the hashes of its distinct
runs of ``size`` words; a text with fewer words has its whole sequence as its one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at once; a single text may be longer.
SLICE_BYTES = 256 << 10
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = values + np.uint64(salt * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0 to n of an odd number, modulo 2 to the 64th."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        steps = np.full(max(n, 2 * SLICE_BYTES) + 2, base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word of the bytes."""
    capital = (data >= 65) & (data <= 90)
    lower = data + (capital * np.uint8(32))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))[:len(data)], out=sums[1:])
    own = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts]
    return starts, mix(own ^ ((ends - starts).astype(np.uint64) << np.uint64(56)))


def _slices(texts: list[str | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; empty without a word."""
    for part in sliced_sets(texts, size):
        yield from part


def sliced_sets(texts: list[str | None], size: int) -> Iterator[list[np.ndarray]]:
    """``shingle_sets`` of neighbouring texts, as many as make a slice."""
    for part in _slices(texts):
        sets = []
        lengths = np.array([len(t) + 1 for t in part])
        first = np.cumsum(lengths) - lengths
        starts, hashes = _word_hashes(np.frombuffer(b" ".join(part), dtype=np.uint8))
        cuts = np.searchsorted(starts, np.append(first, np.iinfo(np.int64).max))
        runs = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
        for place in range(size):
            runs = mix(runs + hashes[place:place + len(runs)], place + 1)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a >= size:
                sets.append(np.unique(runs[a:b - size + 1]))
            elif b > a:
                one = np.zeros(1, dtype=np.uint64)
                for place in range(a, b):
                    one = mix(one + hashes[place], place - a + 1)
                sets.append(mix(one, b - a))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
        yield sets
