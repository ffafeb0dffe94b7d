"""Near-duplicate vectors by p-stable hashing and exact cosine checks.

A table of the index projects the unit vector on ``projections`` Gaussian directions, shifts each by a random
offset, and cuts it into steps of ``width``; vectors whose steps all agree share a bucket. Vectors of one
bucket are compared exactly, in blocks, and a pair counts only in the first table whose bucket it shares, so no
list of pairs is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import components, cut_lineage, null_safe_join
from assayspark.llm.groups import linked_lowest

TABLES = 26
PROJECTIONS = 14
WIDTH = 1.5
SEED = 11
#: Vectors of one bucket in one block; a larger bucket becomes several blocks, compared two at a time.
BLOCK = 256
#: Pairs compared at a time within a task.
PAIRS_AT_ONCE = 1 << 18


def bucket_ids(unit: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """One 64-bit bucket id per vector (row) and table."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((unit.shape[1], tables * projections))
    offsets = rng.uniform(0, width, tables * projections)
    odd = rng.integers(0, 1 << 62, projections, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    steps = np.floor((unit @ directions + offsets) / width).astype(np.int64).astype(np.uint64)
    mixed = (steps.reshape(len(unit), tables, projections) * odd).sum(axis=2, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _usable(vectors: list) -> list[int]:
    return [
        i for i, v in enumerate(vectors)
        if v is not None and len(v) and all(x is not None for x in v) and np.isfinite(np.asarray(v, float)).all()
        and np.any(np.asarray(v, float))
    ]


def _index(tables: int, projections: int, width: float, seed: int):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = batch["vector"].tolist()
            rows = _usable(vectors)
            for size in sorted({len(vectors[i]) for i in rows}):
                own = [i for i in rows if len(vectors[i]) == size]
                unit = np.array([vectors[i] for i in own], dtype=np.float64)
                unit /= np.abs(unit).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                ids = bucket_ids(unit, tables, projections, width, seed)
                yield pd.DataFrame({
                    "label": batch["label"].iloc[own].to_numpy(), "unit": list(unit), "buckets": list(ids),
                    "node": batch["node"].iloc[own].to_numpy(), "copies": batch["copies"].iloc[own].to_numpy(),
                })

    return index


def _compare(least: float, tables: int):
    """Compare the vectors of each block with one another, or with those of a second block.

    Rows come sorted by block. A row of the result is a vector and what one block adds to it.
    """

    def links(rows: pd.DataFrame) -> pd.DataFrame | None:
        """Rows of whole blocks; a block's vectors have one length, several blocks may not."""
        lengths = rows["unit"].map(len).to_numpy()
        parts = [of_length(rows[lengths == n].reset_index(drop=True)) for n in np.unique(lengths)]
        parts = [p for p in parts if p is not None]
        return pd.concat(parts, ignore_index=True) if parts else None

    def of_length(block: pd.DataFrame) -> pd.DataFrame | None:
        left, right = _pairs(block["key"].to_numpy(), block["side"].to_numpy())
        unit, ids = np.stack(block["unit"].to_numpy()), np.stack(block["buckets"].to_numpy())
        nodes, copies = block["node"].to_numpy(), block["copies"].to_numpy()
        table = block["table"].to_numpy()
        found = []
        for at in range(0, len(left), PAIRS_AT_ONCE):
            a, b = left[at:at + PAIRS_AT_ONCE], right[at:at + PAIRS_AT_ONCE]
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= least
            a, b = a[near], b[near]
            same = ids[a] == ids[b]
            first = same.argmax(axis=1) == table[a]
            found.append((a[first], b[first]))
        if not found:
            return None
        a = np.concatenate([x for x, _ in found])
        b = np.concatenate([x for _, x in found])
        if not len(a):
            return None
        gained = np.bincount(a, copies[b], len(block)) + np.bincount(b, copies[a], len(block))
        lowest = linked_lowest(nodes, a, b)
        met = np.flatnonzero(gained)
        return pd.DataFrame({"node": nodes[met], "links": gained[met].astype(np.int64), "lowest": lowest[met]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = rows["key"].to_numpy() == rows["key"].iloc[-1] if len(rows) else np.zeros(0, bool)
            held = rows[last]
            if (~last).any() and (out := links(rows[~last].reset_index(drop=True))) is not None:
                yield out
        if held is not None and len(held) and (out := links(held.reset_index(drop=True))) is not None:
            yield out

    return compare


def _pairs(keys: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs to compare: within a run of equal keys, or across its two sides if it has both."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    left, right = [], []
    sizes = np.diff(edges)
    for size in np.unique(sizes[sizes > 1]):
        starts = edges[:-1][sizes == size]
        i, j = np.triu_indices(size, 1)
        a, b = (starts[:, None] + i).ravel(), (starts[:, None] + j).ravel()
        wanted = sides[a] != sides[b]
        within = sides[a] == 2
        keep = np.where(within, True, wanted)
        left.append(a[keep])
        right.append(b[keep])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def near_vectors(
    rows: DataFrame, least: float = 0.98, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH,
    seed: int = SEED, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is ``least``
    or more. The index finds a pair of cosine 0.98 with probability 0.997 and closer ones more surely; a
    reported link is always exact. n_links counts the other vectors linked directly, component_id is the smallest
    vec_id reachable by links, kept says that it is the vector's own. Vectors that are null, empty, zero or hold
    null or non-finite components, have a null label or a null vec_id link with nothing; vectors of different
    length don't link. Equal vectors of a label are one node of the index with a number of copies. Rows that
    repeat a vec_id count as copies and stay rows of the result. Other columns are not read.
    """
    own = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")
    )
    named = own.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    content = F.sha2(F.to_json(F.struct("vector")), 256)
    classes = cut_lineage(
        named.groupBy("label", content.alias("content")).agg(
            F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vector").alias("vector"),
        )
    )
    label_type = classes.schema["label"].dataType.simpleString()
    indexed = cut_lineage(classes.select("label", "vector", "node", "copies").mapInPandas(
        _index(tables, projections, width, seed),
        f"label {label_type}, unit array<double>, buckets array<long>, node long, copies long",
    ))
    places = indexed.select(
        "node", "label", F.size("unit").alias("width"), F.posexplode("buckets").alias("table", "bucket")
    )
    key = F.xxhash64("label", "width", "table", "bucket")
    crowded = places.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = places.select("node", "table", key.alias("key")).join(crowded, "key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    drawn = F.pmod(F.xxhash64("node", "key"), blocks).cast("int")
    # Block i meets itself once and every other block once: as the lower side 0 or the higher side 1.
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = members.withColumn("own", drawn).withColumn("other", other).select(
        "node", "table",
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
    )
    carried = dealt.join(indexed.select("node", "copies", "unit", "buckets"), "node")
    found = cut_lineage(
        carried.repartition("key").sortWithinPartitions("key", "table", "side", "node")
        .mapInPandas(_compare(least, tables), "node long, links long, lowest long")
    )
    labels = components(found.filter("node != lowest"), "node", "lowest")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    summary = classes.select("label", "content", "node", "copies").join(counts, "node", "left").join(
        labels, "node", "left"
    )
    valid = F.col("good") & F.col("node").isNotNull()
    good = F.exists("vector", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
    good = ~good & F.exists("vector", lambda x: x != 0)
    back = null_safe_join(
        own.select("vec_id", "label", content.alias("content"), F.coalesce(good, F.lit(False)).alias("good")),
        summary.select("label", "content", "node", "copies", "links", "component"), ["label", "content"],
    )
    linked = valid & F.col("vec_id").isNotNull()
    component = F.when(linked, F.coalesce("component", "node")).otherwise(F.col("vec_id"))
    return back.select(
        "vec_id",
        F.when(linked, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
