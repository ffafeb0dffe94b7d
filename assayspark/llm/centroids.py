"""Centroid clustering with a threshold algorithm over sorted lists.

Each dimension has the list of the centroids in order of their component. A vector walks the lists outward from its own component,
the nearer neighbour first, and measures the exact distance of each centroid it meets. The frontier of a list is the
distance, in that dimension, to the nearest centroid not yet read from it. A centroid that was met in no list is at least as far as the sum of the squared
frontiers, so the walk stops when this sum strictly exceeds the best exact distance; equal ones go on, as a lower number may win. It also
stops when no centroid is left to meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import cut_lineage
from assayspark.llm.whole import floored_means, matrix, slot_sums, usable, whole

CENTROIDS = 40
DIMENSIONS = 64
ROUNDS = 5
FACTOR = 256
SEED = 2
#: Lists read in one step, and vectors that walk together.
LISTS_AT_ONCE = 32
VECTORS_AT_ONCE = 2048
_FAR = np.iinfo(np.int64).max
#: Frontier of a list that is read to its end; all centroids have been met then.
_ENDED = 1 << 28


class SortedLists:
    """The centroids in order of each component, with the lists whose neighbours lie farthest apart first."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)
        self.dimensions = np.argsort(-np.ptp(centroids, axis=0), kind="stable")

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, the smaller one of equals, and the squared distance."""
        found = [self._walk(x[at:at + VECTORS_AT_ONCE]) for at in range(0, len(x), VECTORS_AT_ONCE)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _frontier(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance to the next centroid below and above in each of the lists."""
        n = len(self.values)
        below = np.where(low >= 0, x - self.values[np.maximum(low, 0), lists], _ENDED)
        above = np.where(high < n, self.values[np.minimum(high, n - 1), lists] - x, _ENDED)
        return below, above

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, (n, width) = len(x), self.centroids.shape
        high = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(width)], axis=1)
        low = high - 1
        frontier = np.minimum(*self._frontier(x, low, high, np.arange(width))) ** 2
        met, best = np.full((rows, n), _FAR), np.full(rows, _FAR)
        active, turn = np.arange(rows), 0
        while len(active):
            lists = self.dimensions[np.arange(turn, turn + LISTS_AT_ONCE) % width]
            turn += LISTS_AT_ONCE
            own = x[np.ix_(active, lists)]
            at_low, at_high = low[np.ix_(active, lists)], high[np.ix_(active, lists)]
            below, above = self._frontier(own, at_low, at_high, lists)
            down, read = below <= above, np.minimum(below, above) < _ENDED
            centroid = self.order[np.where(down, np.maximum(at_low, 0), np.minimum(at_high, n - 1)), lists]
            fresh = np.zeros((len(active), n), dtype=bool)
            place = np.broadcast_to(np.arange(len(active))[:, None], centroid.shape)
            fresh[place[read], centroid[read]] = True
            fresh &= met[active] == _FAR
            i, j = np.nonzero(fresh)
            exact = ((x[active[i]] - self.centroids[j]) ** 2).sum(axis=1)
            met[active[i], j] = exact
            np.minimum.at(best, active[i], exact)
            at_low, at_high = at_low - (down & read), at_high + (~down & read)
            low[np.ix_(active, lists)], high[np.ix_(active, lists)] = at_low, at_high
            frontier[np.ix_(active, lists)] = np.minimum(*self._frontier(own, at_low, at_high, lists)) ** 2
            unmet = (met[active] == _FAR).any(axis=1)
            active = active[unmet & (frontier[active].sum(axis=1) <= best[active])]
        return met.argmin(axis=1), best


def _tally(lists: SortedLists):
    n, width = lists.centroids.shape

    def fill(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        x = matrix(batch["whole"], width)
        near, _ = lists.nearest(x)
        np.add.at(sums[:n * width].reshape(n, width), near, x)
        sums[n * width:] += np.bincount(near, minlength=n)

    return fill


def _assigner(lists: SortedLists):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                near, distance = lists.nearest(matrix(batch["whole"], lists.centroids.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], pa.array(near, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    return run


def cluster_vectors(
    rows: DataFrame, centroids: int = CENTROIDS, dimensions: int = DIMENSIONS, rounds: int = ROUNDS, factor: int = FACTOR,
    seed: int = SEED, vec_id: str = "vec_id", vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance), one row per kept vector, and the final centroids.

    Kept are vectors of exactly ``dimensions`` components, none null or non-finite, as floor(factor * x). The first centroids are the
    vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order (null vec_ids last, rows that repeat a vec_id in order of
    their components); fewer rows give fewer centroids. Each round replaces a centroid by the floored mean of the vectors nearest to
    it, if any. Distances are squared, ties go to the smaller number. Kept rows in which a component reaches LIMIT
    of ``whole`` have a null cluster and distance and move no centroid. The driver holds the centroids only. Other columns
    are not read.
    """
    own = rows.filter(usable(F.col(vector)) & (F.size(vector) == dimensions)).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole(F.col(vector), factor).alias("whole")
    )
    kept = cut_lineage(own)
    odd = kept.filter("whole is null").select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    fit = kept.filter("whole is not null")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = fit.orderBy(drawn.asc_nulls_last(), "vec_id", "whole").limit(centroids).collect()
    if not first:
        return odd, np.zeros((0, dimensions), dtype=np.int64)
    now = np.array([r.whole for r in first], dtype=np.int64)
    for _ in range(rounds):
        sums = slot_sums(fit.select("whole"), now.size + len(now), _tally(SortedLists(now)))
        now = floored_means(now, sums[:now.size].reshape(now.shape), sums[now.size:])
    found = fit.mapInArrow(_assigner(SortedLists(now)), "vec_id long, cluster int, distance long")
    return cut_lineage(found.unionByName(odd)), now


def cluster_digests(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 from the results of ``cluster_vectors``."""
    spark = clustered.sparkSession
    sums = {r.cluster: r.total for r in clustered.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    inertia = sum(x for k, x in sums.items() if k is not None)
    own = [
        (k, sums.get(k), inertia, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, c in enumerate(centroids.tolist())
    ]
    # One row per centroid.
    small = spark.createDataFrame(own, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clustered.join(F.broadcast(small), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
