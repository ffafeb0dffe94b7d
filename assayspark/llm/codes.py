"""Vector code compression: each part of a vector becomes the number of its nearest codebook entry.

The codebooks are trained in rounds of exact nearest-entry assignments, most of whose distances bounds make unnecessary. A part of a
vector carries its distance to its entry and, for each group of GROUP entries, a lower bound on its distances to the group's
others, each with the round in which it was measured. All codebooks of the rounds so far are kept, so a bound is
weakened by the net displacement of the entries from its own round to the present one (the norm of the sum of their moves),
which is never more than the sum of the norms of these moves. A group is scanned again only if its bound doesn't exclude it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import cut_lineage
from assayspark.llm.whole import floored_means, matrix, slot_sums, squared, usable, whole
from assayspark.operators.scale import attach, release

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
#: Entries that share a lower bound.
GROUP = 16
#: Room for rounding where distances are compared, relative and absolute; a bound that close is not relied on.
SLACK = 1e-6
_FAR = np.iinfo(np.int64).max


class Bounds:
    """Per row: number of the entry, distance to it and its round, lower bound of each group and its round."""

    def __init__(self, code, upper, upper_round, lower, lower_round):
        self.code, self.upper, self.upper_round = code, upper, upper_round
        self.lower, self.lower_round = lower, lower_round

    @classmethod
    def none(cls, rows: int, groups: int) -> Bounds:
        """Bounds that exclude nothing."""
        return cls(np.zeros(rows, np.int64), np.full(rows, np.inf), np.zeros(rows, np.int8),
                   np.zeros((rows, groups), np.float32), np.zeros((rows, groups), np.int8))


def net_displacements(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each entry between each round's codebook and the last, and its maximum in each group."""
    moved = np.sqrt(np.stack([((history[-1] - then) ** 2).sum(axis=1) for then in history]).astype(np.float64))
    edges = np.arange(0, moved.shape[1], GROUP)
    return moved, np.maximum.reduceat(moved, edges, axis=1)


def assign(x: np.ndarray, history: list[np.ndarray], bounds: Bounds, fresh: bool) -> Bounds:
    """Nearest entry of the last codebook for each row, ties to the lower number. ``fresh`` bounds exclude nothing."""
    entries, now = history[-1], len(history) - 1
    groups = -(-len(entries) // GROUP)
    code, upper, upper_round = bounds.code.copy(), bounds.upper.copy(), bounds.upper_round.copy()
    lower, lower_round = bounds.lower.copy(), bounds.lower_round.copy()
    best = np.full(len(x), _FAR)
    if fresh:
        scan = np.ones((len(x), groups), dtype=bool)
    else:
        moved, group_moved = net_displacements(history)
        least = lower - group_moved[lower_round, np.arange(groups)]
        most = upper + moved[upper_round, code]
        scan = least <= (most + SLACK + SLACK * most)[:, None]
        doubtful = np.flatnonzero(scan.any(axis=1))
        best[doubtful] = ((x[doubtful] - entries[code[doubtful]]) ** 2).sum(axis=1)
        upper[doubtful], upper_round[doubtful] = np.sqrt(best[doubtful].astype(np.float64)), now
        exact = upper[doubtful]
        scan[doubtful] = least[doubtful] <= (exact + SLACK + SLACK * exact)[:, None]
        some = np.flatnonzero(scan.any(axis=1))
        # The entry may lose its place: its group's bound, which leaves it out, is measured anew.
        scan[some, code[some] // GROUP] = True
    first, second = np.full((len(x), groups), _FAR), np.full((len(x), groups), _FAR)
    for g in range(groups):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        own = squared(x[rows], entries[g * GROUP:(g + 1) * GROUP])
        at = own.argmin(axis=1)
        nearest = own[np.arange(len(rows)), at]
        own[np.arange(len(rows)), at] = _FAR
        first[rows, g], second[rows, g] = nearest, own.min(axis=1)
        number = g * GROUP + at
        better = (nearest < best[rows]) | ((nearest == best[rows]) & (number < code[rows]))
        code[rows[better]], best[rows[better]] = number[better], nearest[better]
    met = best < _FAR
    upper[met], upper_round[met] = np.sqrt(best[met].astype(np.float64)), now
    others = np.where(np.arange(groups) == (code // GROUP)[:, None], second, first)
    measured = np.nextafter(np.sqrt(others.astype(np.float64)).astype(np.float32), np.float32(0))
    lower[scan], lower_round[scan] = measured[scan], now
    return Bounds(code, upper, upper_round, lower, lower_round)


_STATE = "code array<int>, upper array<double>, upper_round array<byte>, lower array<float>, lower_round array<byte>"


def _assigner(history: list[np.ndarray], parts: int, fresh: bool, schema: pa.Schema, last: bool):
    """Rows with the state after this round, or with ``code`` and ``error`` after the last."""
    _, entries, width = history[-1].shape
    groups = -(-entries // GROUP)

    def state(batch: pa.RecordBatch, part: int) -> Bounds:
        if fresh:
            return Bounds.none(len(batch), groups)

        def column(name: str, width: int) -> np.ndarray:
            flat = batch[name].flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(len(batch), parts, width)[:, part]

        return Bounds(column("code", 1)[:, 0].astype(np.int64), column("upper", 1)[:, 0], column("upper_round", 1)[:, 0],
                      column("lower", groups), column("lower_round", groups))

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        values = values.reshape(len(values), -1)
        ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind.value_type)).cast(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = matrix(batch["whole"], parts * width).reshape(len(batch), parts, width)
            found = [assign(x[:, p], [h[p] for h in history], state(batch, p), fresh) for p in range(parts)]
            code = np.stack([b.code for b in found], axis=1)
            if last:
                near = np.stack([history[-1][p][code[:, p]] for p in range(parts)], axis=1)
                own = {"code": lists(code, schema.field("code").type),
                       "error": pa.array(((x - near) ** 2).sum(axis=(1, 2)), pa.int64())}
            else:
                own = {name: lists(np.stack([getattr(b, name) for b in found], axis=1), schema.field(name).type)
                       for name in ("code", "upper", "upper_round", "lower", "lower_round")}
            yield pa.RecordBatch.from_arrays(
                [own[n] if n in own else batch[n].cast(schema.field(n).type) for n in schema.names], schema=schema
            )

    return run


def _tally(parts: int, entries: int, width: int):
    def fill(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        x, code = matrix(batch["whole"], parts * width), matrix(batch["code"], parts)
        slots = sums[:parts * entries * width].reshape(parts, entries, width)
        counts = sums[parts * entries * width:].reshape(parts, entries)
        for p in range(parts):
            np.add.at(slots[p], code[:, p], x[:, p * width:(p + 1) * width])
            counts[p] += np.bincount(code[:, p], minlength=entries)

    return fill


def compress_vectors(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error), one row per kept vector, and the codebooks (part, entry, position).

    Rows whose vector is null or holds null or non-finite components are dropped. Components become floor(factor * x). A
    codebook starts as that part of the vectors with the ``entries`` smallest vec_ids (null last; rows that repeat a vec_id are
    taken in order of their components); fewer rows give fewer entries. Each round replaces an entry by the floored mean of the parts
    assigned to it, if any. Kept rows have null codes and a null error, and take no part in the codebooks, if their
    length is not that of the smallest usable vec_id, is 0 or no multiple of ``parts``, or if a component reaches LIMIT of ``whole``.
    The driver holds the codebooks of all rounds, ``rounds`` times ``entries`` vectors. Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    own = rows.filter(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), whole(F.col(vector), factor).alias("whole")
    )
    kept = cut_lineage(own)
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole")]
    size = F.size("whole")
    lead = kept.filter((size > 0) & (size % parts == 0)).orderBy(*order).select(size.alias("n")).first()
    fits = F.coalesce(size == (lead.n if lead else -1), F.lit(False))
    odd = kept.filter(~fits).select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"),
                                    F.lit(None).cast("long").alias("error"))
    if lead is None:
        return odd, np.zeros((parts, 0, 0), dtype=np.int64)
    width = lead.n // parts
    now = kept.filter(fits)
    start = np.array([r.whole for r in now.orderBy(*order).limit(entries).collect()], dtype=np.int64)
    history = [start.reshape(len(start), parts, width).transpose(1, 0, 2)]
    held = history[0].shape[1]
    empty = kept.limit(0).select("vec_id", "label", "whole")
    for field in _STATE.split(", "):
        empty = empty.withColumn(field.split()[0], F.lit(None).cast(field.split()[1]))
    schema, before = empty.schema, None
    for number in range(rounds):
        step = _assigner(history, parts, number == 0, to_arrow_schema(schema), False)
        following = cut_lineage(now.mapInArrow(step, schema))
        sums = slot_sums(following.select("whole", "code"), parts * held * (width + 1), _tally(parts, held, width))
        means = sums[:parts * held * width].reshape(parts, held, width)
        counts = sums[parts * held * width:].reshape(parts, held)
        history.append(np.stack([floored_means(history[-1][p], means[p], counts[p]) for p in range(parts)]))
        if before is not None:
            release(before)
        now = before = following
    schema = empty.select("vec_id", "label", "code", F.lit(None).cast("long").alias("error")).schema
    step = _assigner(history, parts, rounds == 0, to_arrow_schema(schema), True)
    coded = cut_lineage(now.mapInArrow(step, schema).withColumnRenamed("code", "codes"))
    if before is not None:
        release(before)
    return coded.unionByName(odd), history[-1]


def code_digests(coded: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 from the results of ``compress_vectors``."""
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    joined = attach(coded.select("vec_id", "label", code.alias("code"), "error"), sums, ["label"], rows_per_key="_n")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
