"""Ranking of samples by analyte concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.operators.scale import cut_lineage, placed_rows, session_partitions


def rank_avg(df: DataFrame, analyte: list[str], value: str, out: str = "rank") -> DataFrame:
    """Rank of the value within its analyte, highest first, ties averaged; NULL values rank NULL.

    The rows get their rank where their slice of the values is, so neither a frequent value nor NULL meets in one task.
    """
    turned = df.withColumn("_turned", -F.col(value))
    placed = placed_rows(turned.filter(F.col("_turned").isNotNull()), analyte, "_turned", session_partitions(df.sparkSession))
    ranked = placed.select(*df.columns, (F.col("_before") + (F.col("_ties") + 1) / 2).alias(out))
    unranked = turned.filter(F.col("_turned").isNull()).select(*df.columns, F.lit(None).cast("double").alias(out))
    return ranked.unionByName(unranked)


def rank_sum(ranked: DataFrame, sample: list[str], analyte: str, rank: str = "rank", ordered: bool = True) -> DataFrame:
    """Sum of a sample's ranks over all analytes and its dense place, lowest sum first.

    A sample that lacks an analyte has no sum.
    """
    kept = cut_lineage(ranked.select(*sample, analyte, rank))
    analytes = kept.select(F.count_distinct(analyte)).scalar()
    sums = kept.groupBy(*sample).agg(
        F.count(rank).alias("_seen"), F.sum(rank).alias("_sum")
    ).withColumn("_analytes", analytes)
    summed = cut_lineage(sums.select(
        *sample, F.when(F.col("_seen") == F.col("_analytes"), F.col("_sum")).alias("rank_sum")
    ))
    columns = [*sample, "rank_sum"]
    placed = placed_rows(summed.filter(F.col("rank_sum").isNotNull()), [], "rank_sum").select(*columns, F.col("_dense").alias("place"))
    missing = summed.filter(F.col("rank_sum").isNull()).select(*columns, F.lit(None).cast("bigint").alias("place"))
    out = placed.unionByName(missing)
    return out.orderBy(F.asc_nulls_last("rank_sum")) if ordered else out
