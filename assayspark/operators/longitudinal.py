"""Subjects followed over time: ratios to the lowest value and spread within against between subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayspark.functions.aggregates import centred_sum_of_squares, sd
from assayspark.functions.expressions import floor_zero
from assayspark.operators.filters import complete_subjects
from assayspark.operators.reshape import distinct_first
from assayspark.operators.scale import attach, cut_lineage

VALUE = "concentration_ug_ml"


def _strict_min(value: str) -> Column:
    return F.when(F.count(value) == F.count(F.lit(1)), F.min(value))


def ratio_to_group_min(df: DataFrame, group: list[str], value: str = VALUE, out: str = "concentration_r") -> DataFrame:
    """Value over the smallest value of its group; NULL if the group has a NULL."""
    lowest = df.groupBy(*group).agg(_strict_min(value).alias("_lowest"), F.count(F.lit(1)).alias("_rows_of_key"))
    joined = attach(df, lowest, group, rows_per_key="_rows_of_key")
    return joined.withColumn(out, F.try_divide(F.col(value), F.col("_lowest"))).drop("_lowest")


def longitudinal(
    df: DataFrame, subject: str, analyte: list[str], timepoint: str, order_by: list[str], value: str = VALUE,
    study: DataFrame | None = None,
) -> DataFrame:
    """First row per subject, analyte and timepoint of subjects seen more than once, with
    ``concentration_r``, ``total_sd`` per analyte, ``group_sd`` per subject and analyte and their ratio.

    ``study`` has the study's analytes, more than which a subject's rows must be; without it they are those of the rows.
    """
    first = distinct_first(df, [subject, *analyte, timepoint], order_by)
    floored = cut_lineage(first.withColumn(value, floor_zero(F.col(value))))
    kept = complete_subjects(floored, subject, analyte, study)
    rows = F.count(F.lit(1)).alias("_rows_of_key")
    total = kept.groupBy(*analyte).agg(sd(value).alias("total_sd"), rows)
    within = kept.groupBy(subject, *analyte).agg(sd(value).alias("group_sd"), _strict_min(value).alias("_lowest"), rows)
    described = attach(
        attach(kept, total, analyte, rows_per_key="_rows_of_key"),
        within, [subject, *analyte], rows_per_key="_rows_of_key",
    )
    return described.withColumns({
        "concentration_r": F.try_divide(F.col(value), F.col("_lowest")),
        "sdr": F.try_divide(F.col("group_sd"), F.col("total_sd")),
    }).drop("_lowest")


def subject_deviations(
    df: DataFrame, subject: str, analyte: list[str], timepoint: str, order_by: list[str], value: str = VALUE,
    study: DataFrame | None = None,
) -> DataFrame:
    """``sd_ratio`` of ``longitudinal`` from summaries alone: one row per subject and analyte, no join of rows.

    A subject's values of an analyte become count, mean and squares about it; an analyte's squares are those within its subjects
    plus those between their means. A NULL among the values makes the deviation NULL, as there.
    """
    keys = [subject, *analyte]
    floored = distinct_first(df, [*keys, timepoint], order_by).withColumn(value, floor_zero(F.col(value)))
    own = cut_lineage(floored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_mean"), centred_sum_of_squares(value).alias("_ss"),
        (F.count(value) < F.count(F.lit(1))).alias("_gap"),
    ))
    analytes = (own if study is None else study).select(F.count_distinct(F.struct(*analyte))).scalar()
    # A subject has at most one row per analyte here.
    whole = own.withColumn("_rows", F.sum("_n").over(Window.partitionBy(subject))).withColumn("_analytes", analytes)
    kept = cut_lineage(whole.filter(F.col("_rows") > F.col("_analytes")).drop("_rows", "_analytes"))
    centres = kept.groupBy(*analyte).agg(
        F.sum("_n").alias("_all"), (F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("_centre"),
        F.max("_gap").alias("_any_gap"), F.count(F.lit(1)).alias("_rows_of_key"),
    )
    placed = cut_lineage(attach(kept, centres, analyte, rows_per_key="_rows_of_key"))
    off = F.col("_mean") - F.col("_centre")
    total = placed.groupBy(*analyte).agg(
        F.sum(F.col("_ss") + F.col("_n") * off * off).alias("_total"), F.count(F.lit(1)).alias("_rows_of_key"),
    )
    found = attach(placed, total, analyte, rows_per_key="_rows_of_key")

    def deviation(squares: str, n: str, gap: str) -> Column:
        return F.when(~F.col(gap) & (F.col(n) > 1), F.sqrt(F.try_divide(F.col(squares), F.col(n) - 1.0)))

    return found.select(
        *keys, deviation("_ss", "_n", "_gap").alias("group_sd"), deviation("_total", "_all", "_any_gap").alias("total_sd"),
    ).withColumn("sdr", F.try_divide(F.col("group_sd"), F.col("total_sd")))


def sd_ratio(longit: DataFrame, subject: str, analyte: list[str]) -> DataFrame:
    """One row per subject and analyte with both deviations and their ratio."""
    return longit.groupBy(subject, *analyte).agg(
        *[F.max(c).alias(c) for c in ("group_sd", "total_sd", "sdr")]
    )


def mean_sd_ratio(ratios: DataFrame, analyte: list[str]) -> DataFrame:
    return ratios.groupBy(*analyte).agg(F.avg("sdr").alias("mean_sdr"))
