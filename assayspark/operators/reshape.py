"""Long to wide, wide to long, distinct rows, set operations and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.functions.aggregates import first_row
from assayspark.operators.scale import SLICE, attach, in_slices, running

def pivot_levels(df: DataFrame, key: str, max_levels: int = 10_000) -> list[str]:
    """Distinct key values in order; they become columns, so more than ``max_levels`` is an error."""
    found = df.select(key).filter(F.col(key).isNotNull()).distinct().limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{key} has more than {max_levels} levels")
    return sorted(row[0] for row in found)


def _wide_name(level, value: str, rename: bool, camel: bool) -> str:
    if not rename:
        return str(level)
    return f"{level}{value[:1].upper()}{value[1:]}" if camel else f"{level}_{value}"


def pivot_multi(
    df: DataFrame,
    ids: list[str],
    key: str,
    values: list[str],
    levels: list | None = None,
    rest: list[str] | None = None,
    order_by: list[str] | None = None,
    rename: bool = True,
    camel: bool = False,
    on_duplicate: str = "error",
    max_levels: int = 10_000,
) -> DataFrame:
    """Long to wide in one aggregation, one column per level and value; absent cells are NULL.

    ``rest`` columns come from the id's first row in ``order_by``. A repeated (id, key) is an error,
    or is settled by ``on_duplicate="mean"`` or ``"first"``. More than ``max_levels`` distinct keys are an
    error, as each becomes columns; the long form has no such limit.
    """
    if not rename and len(values) != 1:
        raise ValueError("unsuffixed names need a single value column")
    levels = pivot_levels(df, key, max_levels) if levels is None else levels
    aggregates, cells = [], []
    for i, level in enumerate(levels):
        here = F.col(key) == F.lit(level)
        aggregates.append(F.count(F.when(here, 1)).alias(f"_n{i}"))
        for j, value in enumerate(values):
            cell = F.when(here, F.col(value))
            if on_duplicate == "mean":
                picked = F.avg(cell)
            elif on_duplicate == "first":
                if not order_by:
                    raise ValueError("on_duplicate='first' needs order_by")
                picked = F.min_by(F.col(value), F.when(here, F.struct(*order_by)))
            else:
                picked = F.max(cell)
            aggregates.append(picked.alias(f"_v{i}_{j}"))
            out = F.col(f"_v{i}_{j}")
            if on_duplicate == "error":
                message = F.lit(f"more than one row per id for {key}={level}")
                out = F.when(F.col(f"_n{i}") > 1, F.raise_error(message).cast(df.schema[value].dataType)).otherwise(out)
            cells.append(out.alias(_wide_name(level, value, rename, camel)))
    if rest:
        aggregates.append(first_row(rest, order_by).alias("_rest"))
    wide = df.groupBy(*ids).agg(*aggregates)
    return wide.select(*ids, *([f"_rest.{c}" for c in rest] if rest else []), *cells)


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, name, value)


def distinct_first(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the first in the given total order."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(first_row(others, order_by).alias("_first"))
    return picked.select(*[c if c in keys else F.col(f"_first.{c}") for c in df.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column; NULL counts as a value."""
    return df.select(column).distinct()


def union_sets(*frames: DataFrame) -> DataFrame:
    """Stack by column name; absent columns are NULL and duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_difference(full: DataFrame, part: DataFrame) -> DataFrame:
    """Distinct rows of ``full`` that are not in ``part``."""
    return full.subtract(part)


def train_test_split(
    df: DataFrame, analyte: list[str], row_key: list[str], fraction: float = 0.3, seed: int = 1354
) -> DataFrame:
    """Add ``is_train``: the round(fraction * n) rows of each analyte that come first in order of a md5.

    It is taken of the seed and the row's key, joined by ``|``, so any engine draws the same rows; a NULL in the key counts as
    empty. ``row_key`` identifies a row within its analyte.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_key]
    drawn = df.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *texts)))
    placed = running(
        in_slices(drawn.withColumn("_one", F.lit(1)), analyte, ["_draw", *row_key]),
        analyte, ["_draw", *row_key], sums={"_place": "_one"},
    )
    sizes = df.groupBy(*analyte).agg(F.round(fraction * F.count(F.lit(1))).alias("_take"))
    return (
        attach(placed, sizes, analyte)
        .withColumn("is_train", F.col("_place") <= F.col("_take"))
        .drop("_draw", "_one", "_place", "_take", SLICE)
    )
