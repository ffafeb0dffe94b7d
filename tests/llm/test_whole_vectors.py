"""Vector codes and centroid clusters against brute force, with nulls, odd lengths, ties, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from assayspark.llm import codes
from assayspark.llm.centroids import SortedLists, cluster_digests, cluster_vectors
from assayspark.llm.codes import Bounds, assign, code_digests, compress_vectors, net_displacements
from assayspark.llm.whole import LIMIT, floored_means, squared

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, whole int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 3) for i, v, label in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def floored(v, factor):
    return [math.floor(factor * float(np.float32(x))) for x in v]


def nearest(x, centres):
    best = min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centres))
    return best[1], best[0]


def moved(x, near, centres):
    out = []
    for k, c in enumerate(centres):
        own = [v for v, n in zip(x, near, strict=True) if n == k]
        out.append([sum(col) // len(own) for col in zip(*own, strict=True)] if own else c)
    return out


def brute_codes(rows, parts, entries, rounds, factor):
    kept = [(i, floored(v, factor), label) for i, v, label in rows if usable(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    fit = [r for r in order if max(map(abs, r[1]), default=0) < LIMIT]
    length = next((len(r[1]) for r in fit if len(r[1]) and len(r[1]) % parts == 0), -1)
    fit = [r for r in fit if len(r[1]) == length]
    width = max(length, 0) // parts
    cut = [[r[1][p * width:(p + 1) * width] for r in fit] for p in range(parts)]
    books = [c[:entries] for c in cut]
    for _ in range(rounds):
        books = [moved(cut[p], [nearest(x, books[p])[0] for x in cut[p]], books[p]) for p in range(parts)]
    found = {}
    for k, r in enumerate(fit):
        near = [nearest(cut[p][k], books[p]) for p in range(parts)]
        found.setdefault((r[0], tuple(r[1])), ("".join(f"{n:02x}" for n, _ in near), sum(d for _, d in near)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, label, *found.get((i, tuple(v)), (None, None))) for i, v, label in kept]
    sums = {}
    for _, label, _, error in coded:
        if error is not None:
            sums[label] = sums.get(label, 0) + error
    return sorted(((i, code, error, sums.get(label), digest) for i, label, code, error in coded), key=repr)


def vectors(n, width, seed, steps=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width))
    out = centres[draw.integers(0, 5, n)] + draw.normal(size=(n, width)) * 0.2
    return (np.round(out * steps) / steps if steps else out).astype(np.float32).tolist()


@pytest.mark.parametrize(("width", "entries", "steps"), [(8, 40, 0), (4, 19, 2), (8, 1, 1)])
def test_vector_codes(spark, width, entries, steps):
    own = vectors(120, width, entries, steps)
    rows = [(i * 3 % 120, v, None if i % 5 == 0 else i % 3) for i, v in enumerate(own)]
    rows += [(7, own[0], 1), (7, own[1], 1), (None, own[2], 2), (200, None, 1), (201, [1.0, None] * (width // 2), 1),
             (202, [float("nan")] * width, 1), (203, [float("inf")] + [0.0] * (width - 1), 1), (204, [1.0] * (width + 4), 9),
             (205, [], 9), (-9, [1e30] + [0.0] * (width - 1), 9), (-8, [1.0] * (width - 1), None)]
    found = code_digests(*compress_vectors(frame(spark, rows), entries=entries, rounds=3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_codes(rows, 4, entries, 3, 1024)


def test_vector_codes_without_rows(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1), (2, [1.0, 2.0, 3.0], None)]):
        coded, books = compress_vectors(frame(spark, rows))
        assert [(r.code, r.error, r.label_error) for r in code_digests(coded, books).collect()] == \
            [(None, None, None)] * sum(usable(v) for _, v, _ in rows)
        assert books.size == 0


def test_bounds_keep_the_nearest_entry_and_spare_scans(monkeypatch):
    draw = np.random.default_rng(3)
    x = draw.integers(-40, 40, (400, 4)) + 400 * draw.integers(0, 4, (400, 1))
    history, bounds, measured = [x[:70].copy()], Bounds.none(400, 5), []
    monkeypatch.setattr(codes, "squared", lambda a, b: measured.append(len(a) * len(b)) or squared(a, b))
    for number in range(6):
        bounds = assign(x, history, bounds, number == 0)
        exact = squared(x, history[-1])
        assert (bounds.code == exact.argmin(axis=1)).all()
        sums = np.zeros((70, 4), dtype=np.int64)
        np.add.at(sums, bounds.code, x)
        history.append(floored_means(history[-1], sums, np.bincount(bounds.code, minlength=70)))
    assert sum(measured) < 0.6 * 6 * 400 * 70


def test_net_displacement_is_not_the_sum_of_moves():
    there = np.array([[0, 0]]), np.array([[3, 4]]), np.array([[0, 0]])
    entry, group = net_displacements(list(there))
    assert entry[:, 0].tolist() == [0, 5, 0] and group[:, 0].tolist() == [0, 5, 0]


def test_squared_distances_beyond_floating_point():
    x, c = np.array([[LIMIT - 1] * 8192, [3] * 8192]), np.array([[1 - LIMIT] * 8192, [3] * 8191 + [4]])
    assert squared(x, c).tolist() == [[8192 * (2 * LIMIT - 2) ** 2, 8191 * (LIMIT - 4) ** 2 + (LIMIT - 5) ** 2], [8192 * (LIMIT + 2) ** 2, 1]]


def brute_clusters(rows, n, width, rounds, factor, seed):
    kept = [(i, floored(v, factor)) for i, v, _ in rows if usable(v) and len(v) == width]
    fit = [r for r in kept if max(map(abs, r[1])) < LIMIT]

    def place(r):
        return (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1])

    centres = [v for _, v in sorted(fit, key=place)[:n]]
    for _ in range(rounds):
        centres = moved([v for _, v in fit], [nearest(v, centres)[0] for _, v in fit], centres)
    near = [(i, *(nearest(v, centres) if max(map(abs, v)) < LIMIT else (None, None))) for i, v in kept]
    sums = [sum(d for _, k, d in near if k == c) for c in range(len(centres))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, *((None,) * 3 if k is None else (sums[k], sum(sums), shas[k]))) for i, k, d in near), key=repr)


@pytest.mark.parametrize(("width", "n", "steps"), [(64, 40, 0), (3, 7, 1), (9, 1, 3), (2, 300, 1)])
def test_centroid_clusters(spark, width, n, steps):
    own = vectors(150, width, n, steps)
    rows = [(i, v, 1) for i, v in enumerate(own)]
    rows += [(7, own[0], 1), (7, own[1], 1), (None, own[2], 2), (200, None, 1), (201, [None] * width, 1), (203, [float("-inf")] * width, 1),
             (202, [float("nan")] * width, 1), (204, [1.0] * (width + 1), 9), (205, [], 9), (206, [-1e30] * width, None)]
    found = cluster_digests(*cluster_vectors(frame(spark, rows), n, width, 3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_clusters(rows, n, width, 3, 256, 2)


def test_centroid_clusters_without_rows(spark):
    for rows, left in (([], 0), ([(1, None, 1)], 0), ([(2, [1e30] * 64, None)], 1)):
        assert [tuple(r)[1:] for r in cluster_digests(*cluster_vectors(frame(spark, rows))).collect()] == [(None,) * 5] * left


def test_walk_stops_before_far_centroids():
    draw = np.random.default_rng(1)
    centres = draw.integers(-1000, 1000, (200, 3))
    x = draw.integers(-1000, 1000, (500, 3))
    lists, read = SortedLists(centres), []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                read.append(len(key))
            return super().__getitem__(key)

    lists.centroids = centres.view(Counting)
    near, distance = lists.nearest(x)
    exact = squared(x, centres)
    assert (near == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert sum(read) < 0.4 * 500 * 200
