"""Whole load of one sample set: read, join dimensions, derive ids, drop botched runs, fill defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayspark.functions.expressions import TRIAL_PATTERN, extract_curve_point, extract_int, fill_defaults
from assayspark.operators.joins import drop_botched, enrich_left
from assayspark.operators.replicates import with_run_and_trial, with_spike
from assayspark.sources.reports import (
    CONCENTRATION_SCHEMA, CURVE_CONCENTRATION_SCHEMA, INFO_SCHEMA, read_dimension, read_report,
)


def tag_set(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("set", F.lit(name))


def prepare_assay_set(
    report: DataFrame, info: DataFrame, amounts: DataFrame, set_name: str,
    botched: DataFrame | None = None, stock: float = 40.0,
) -> DataFrame:
    """Long report of one set with dimensions, ids, spike amounts and defaults."""
    with_protein = enrich_left(report, info, "peptide", ["protein"])
    described = enrich_left(with_protein, amounts, "peptide", ["fmol_ug", "loq_ug_ml", "lod"])
    derived = with_spike(with_run_and_trial(tag_set(described, set_name)), stock)
    return fill_defaults(derived if botched is None else drop_botched(derived, botched))


def load_assay_set(
    spark: SparkSession, paths: Mapping[str, str], set_name: str,
    botched: Iterable[int] = (), stock: float = 40.0,
) -> DataFrame:
    """``paths`` names the ``report``, ``peptide_info`` and ``peptide_concentration`` files."""
    runs = [(set_name, int(r)) for r in botched]
    listed = spark.createDataFrame(runs, "set string, run bigint") if runs else None
    return prepare_assay_set(
        read_report(spark, paths["report"], "multiset"),
        read_dimension(spark, paths["peptide_info"], INFO_SCHEMA),
        read_dimension(spark, paths["peptide_concentration"], CONCENTRATION_SCHEMA),
        set_name, listed, stock,
    )


def prepare_calibration(report: DataFrame, info: DataFrame, amounts: DataFrame, stock: float = 40.0) -> DataFrame:
    """Long calibration report with trial, curve point and spike amounts from the dimensions."""
    described = enrich_left(report.drop("protein"), info, "peptide", ["protein"])
    amounted = enrich_left(described, amounts, "peptide", ["fmol_ug"])
    return with_spike(amounted.withColumns({
        "trial": extract_int("replicate_name", TRIAL_PATTERN),
        "curvepoint": extract_curve_point("replicate_name"),
    }), stock)


def load_calibration(spark: SparkSession, paths: Mapping[str, str], stock: float = 40.0) -> DataFrame:
    return prepare_calibration(
        read_report(spark, paths["report"], "calibration"),
        read_dimension(spark, paths["peptide_info"], INFO_SCHEMA),
        read_dimension(spark, paths["peptide_concentration"], CURVE_CONCENTRATION_SCHEMA),
        stock,
    )
