"""Correlation of every item pair over shared row keys, without a wide table or a row self-join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.operators.scale import cut_lineage, null_safe_join

TILE_ITEMS = 1024
#: Row vectors of a tile that one task adds up; a tile with more is cut into as many pieces as that takes.
VECTORS_PER_PIECE = 200_000
#: Vectors written out in full at a time.
ROWS_AT_ONCE = 1024
GRAM_SCHEMA = "a string, b string, xy double"


class _Tile:
    """The products of one tile of items, added up batch by batch."""

    def __init__(self, tile: tuple[int, int]):
        self.tile = tile
        self.index: dict[tuple[int, str], int] = {}
        self.gram = np.zeros((0, 0))

    def add(self, part: pd.DataFrame) -> None:
        at_row = np.repeat(np.arange(len(part)), part["items"].map(len).to_numpy())
        names = [(b, i) for blocks, items in zip(part["blocks"], part["items"], strict=True)
                 for b, i in zip(blocks, items, strict=True)]
        at_item = np.array([self.index.setdefault(name, len(self.index)) for name in names], dtype=int)
        if len(self.index) > len(self.gram):
            grown = np.zeros((len(self.index), len(self.index)))
            grown[: len(self.gram), : len(self.gram)] = self.gram
            self.gram = grown
        amounts = np.concatenate(part["amounts"].to_numpy())
        ends = np.searchsorted(at_row, np.arange(0, len(part) + ROWS_AT_ONCE, ROWS_AT_ONCE))
        for first, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            vectors = np.zeros((min(ROWS_AT_ONCE, len(part) - first * ROWS_AT_ONCE), len(self.index)))
            vectors[at_row[a:b] - first * ROWS_AT_ONCE, at_item[a:b]] = amounts[a:b]
            self.gram += vectors.T @ vectors

    def rows(self) -> Iterator[pd.DataFrame]:
        blocks = np.array([b for b, _ in self.index])
        labels = np.array([i for _, i in self.index], dtype=object)
        for row, (block, label) in enumerate(zip(blocks, labels, strict=True)):
            other = self.tile[1] if block == self.tile[0] else self.tile[0]
            mates = np.flatnonzero(blocks == other)
            if len(mates):
                yield pd.DataFrame({"a": label, "b": labels[mates], "xy": self.gram[row, mates]})


def _partial_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sum x*y over row vectors that come in order of their tile; one tile's matrix is held at a time."""
    held: _Tile | None = None
    for batch in batches:
        tiles = batch[["tile_a", "tile_b"]].to_numpy()
        cuts = np.flatnonzero((tiles[1:] != tiles[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(batch)], strict=True):
            if a == b:
                continue
            tile = tuple(tiles[a].tolist())
            if held is None or held.tile != tile:
                if held is not None:
                    yield from held.rows()
                held = _Tile(tile)
            held.add(batch.iloc[a:b])
    if held is not None:
        yield from held.rows()


def cross_correlation(
    df: DataFrame, row_key: list[str], item: str, value: str, digits: int = 2,
    on_duplicate: str = "error", tile_items: int = TILE_ITEMS, ordered: bool = True,
) -> DataFrame:
    """Pearson correlation of all item pairs, both orders and self pairs, as (item, combination, correlation).

    A missing cell counts as 0 and values are rounded first, so sums are kept as exact whole numbers.
    Each row key becomes one sparse vector no longer than the list of items; tasks add up partial products per tile of
    items, one tile after the other, so that a task holds one matrix of at most twice ``tile_items`` squared. NULL where an item
    does not vary.
    """
    found = df.groupBy(*row_key, F.col(item).alias("_item")).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.avg(value) if on_duplicate == "mean" else F.max(value)).alias("_value"),
    )
    scale = 10.0 ** digits
    amount = F.round(F.round(F.coalesce(F.col("_value"), F.lit(0.0)), digits) * scale, 0)
    if on_duplicate == "error":
        amount = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"more than one {item} per row key")).cast("double")) \
            .otherwise(amount)
    cells = cut_lineage(found.select(F.struct(*row_key).alias("_row"), "_item", amount.alias("_amount")))
    per_item = cut_lineage(
        cells.groupBy("_item").agg(F.sum("_amount").alias("_x"), F.sum(F.col("_amount") * F.col("_amount")).alias("_xx"))
    )
    tiles = max(1, math.ceil(per_item.count() / tile_items))
    # One vector of zeros over all items makes every pair appear, also pairs that share no row key.
    zeros = per_item.select(F.lit(None).cast(cells.schema["_row"].dataType).alias("_row"), "_item", F.lit(0.0).alias("_amount"))
    block = F.pmod(F.xxhash64("_item"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    spread = cells.withColumn("_real", F.lit(True)).unionByName(zeros.withColumn("_real", F.lit(False))) \
        .withColumn("_block", block).withColumn("_other", other)
    vectors = spread.groupBy(
        "_real", "_row", F.least("_block", "_other").alias("tile_a"), F.greatest("_block", "_other").alias("tile_b")
    ).agg(F.collect_list(F.struct("_block", "_item", "_amount")).alias("_cells"), F.xxhash64("_row").alias("_salt"))
    row_keys = cells.select(F.count_distinct("_row")).first()[0]
    pieces = max(1, math.ceil(row_keys / VECTORS_PER_PIECE))
    if tiles > 1:
        vectors = vectors.repartition("tile_a", "tile_b", F.pmod("_salt", F.lit(pieces)))
    gram = vectors.sortWithinPartitions("tile_a", "tile_b").select(
        "tile_a", "tile_b", F.col("_cells._block").alias("blocks"), F.col("_cells._item").alias("items"),
        F.col("_cells._amount").alias("amounts"),
    ).mapInPandas(_partial_products, GRAM_SCHEMA).groupBy("a", "b").agg(F.sum("xy").alias("xy"))
    first = per_item.select(F.col("_item").alias("a"), F.col("_x").alias("_xa"), F.col("_xx").alias("_xxa"))
    second = per_item.select(F.col("_item").alias("b"), F.col("_x").alias("_xb"), F.col("_xx").alias("_xxb"))
    joined = null_safe_join(null_safe_join(gram, first, ["a"]), second, ["b"]).withColumn("_n", F.lit(float(row_keys)))
    n, xa, xb = F.col("_n"), F.col("_xa"), F.col("_xb")
    spread_ab = F.sqrt((n * F.col("_xxa") - xa * xa) * (n * F.col("_xxb") - xb * xb))
    out = joined.select(
        F.col("a").alias(item), F.col("b").alias("combination"),
        F.try_divide(n * F.col("xy") - xa * xb, spread_ab).alias("correlation"),
    )
    return out.orderBy(F.asc(item), F.desc("combination")) if ordered else out
