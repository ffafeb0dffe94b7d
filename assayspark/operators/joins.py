"""Dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.operators.reshape import distinct_first
from assayspark.operators.scale import null_safe_join


def enrich_left(df: DataFrame, dimension: DataFrame, on: str, columns: list[str] | None = None) -> DataFrame:
    """Left join to a dimension with one row per key; NULL meets NULL.

    A key that repeats is an error when the result is computed: the plan itself counts the rows of each key. Spark broadcasts the
    dimension if it is small and splits frequent keys otherwise.
    """
    others = columns or [c for c in dimension.columns if c != on]
    keyed = dimension.groupBy(on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_own"))
    single = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"dimension key {on} repeats")).cast("boolean")).otherwise(True)
    checked = keyed.filter(single).select(on, *[F.col(f"_own.{c}").alias(c) for c in others])
    return null_safe_join(df, checked, [on])


def lookup_first(
    df: DataFrame, dimension: DataFrame, on: str, columns: list[str], order_by: list[str]
) -> DataFrame:
    """Left join to the first dimension row per key, so the row count never grows."""
    needed = list(dict.fromkeys([on, *columns, *[c.removeprefix("-") for c in order_by]]))
    first = distinct_first(dimension.select(*needed), [on], order_by)
    return null_safe_join(df, first.select(on, *columns), [on])


def drop_botched(df: DataFrame, botched: DataFrame) -> DataFrame:
    """Remove rows whose (set, run) is listed; a NULL run is not listed and stays."""
    listed = botched.filter(F.col("run").isNotNull()).select("set", F.col("run").cast("bigint").alias("run")).distinct()
    return null_safe_join(df, listed, ["set", "run"], how="left_anti")
