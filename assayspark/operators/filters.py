"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.operators.scale import attach


def drop_unknown(df: DataFrame, group: str) -> DataFrame:
    """Rows of a known group; NULL and ``unknown`` go."""
    return df.filter(F.col(group) != "unknown")


def limit_categories(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Keep the listed categories and add their place in the list as ``category_order``."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(column))
    return df.withColumn("category_order", place.cast("int")).filter(F.col("category_order") > 0)


def complete_subjects(df: DataFrame, subject: str, analyte: list[str], study: DataFrame | None = None) -> DataFrame:
    """Rows of subjects that have more rows than the study has analytes, hence more than one timepoint.

    ``study`` has the study's analytes, once or more often; without it they are those of the rows.
    """
    analytes = (df if study is None else study).select(F.count_distinct(F.struct(*analyte))).scalar()
    kept = df.groupBy(subject).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > analytes)
    return attach(df, kept.select(subject), [subject], how="left_semi")


def in_linear_range(points: DataFrame) -> DataFrame:
    """Curve points that are precise and above the limit; an unknown verdict goes."""
    return points.filter(F.col("cthr"))


def condition_subset(df: DataFrame, column: str, keep: list | None = None, drop: list | None = None) -> DataFrame:
    """Rows whose value is among ``keep`` and not among ``drop``; a NULL value goes."""
    out = df.filter(F.col(column).isNotNull())
    if keep is not None:
        out = out.filter(F.col(column).isin(keep))
    if drop:
        out = out.filter(~F.col(column).isin(drop))
    return out


def significant(df: DataFrame, p: str, alpha: float = 0.05, inclusive: bool = False) -> DataFrame:
    """Omnibus tests pass below alpha, pairwise ones up to and including it."""
    return df.filter(F.col(p) <= alpha if inclusive else F.col(p) < alpha)


def above_lod(df: DataFrame, value: str = "concentration_ug_ml", lod: str = "lod") -> DataFrame:
    return df.filter(F.col(value) > F.col(lod))
