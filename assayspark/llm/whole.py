"""Vectors as whole numbers, and sums over them that come out alike in any order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of this size or more are not worked with, so that squared distances and their sums stay exact 64-bit numbers.
LIMIT = 1 << 20


def usable(vector: Column) -> Column:
    """True for a vector that is not null and whose components are neither null nor non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def whole(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component as int; null if one of them reaches LIMIT."""
    scaled = F.transform(vector, lambda x: x.cast("double") * factor)
    fits = F.forall(scaled, lambda x: (F.floor(x) < LIMIT) & (F.floor(x) > -LIMIT))
    return F.when(fits, F.transform(scaled, lambda x: F.floor(x).cast("int")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` numbers as a 64-bit matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to each centre."""
    width = x.shape[1]
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(centres).max(initial=0))
    if width * reach * reach < 1 << 52:
        # Every number met is whole and below 2 to the 53rd, so floating point is exact.
        a, b = x.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.empty((len(x), len(centres)), dtype=np.int64)
    for k, centre in enumerate(centres):
        out[:, k] = ((x - centre) ** 2).sum(axis=1)
    return out


def slot_sums(rows: DataFrame, slots: int, fill: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """Sums in ``slots`` numbered places; ``fill`` adds a batch's share. Each task sends its places that are not 0, added up by Spark.

    The caller bounds ``slots``, which reach the driver.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            if len(batch):
                fill(batch, sums)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(sums[met], pa.int64())], ["slot", "amount"])

    total = np.zeros(slots, dtype=np.int64)
    for row in rows.mapInArrow(parts, "slot long, amount long").groupBy("slot").agg(F.sum("amount").alias("amount")).collect():
        total[row.slot] = row.amount
    return total


def floored_means(before: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """floor(sum / count) for each centre (row) with a count, the others as before."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], before)
