"""The three study flows: sample sets, calibration curve, paired biomarkers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from assayspark.operators.calibration import (
    calibration_fit, curve_points, curve_replicates, limit_of_quantification, linear_range, optimal_spike,
    tidify_calibration,
)
from assayspark.operators.classify import classifier_table, marker_score, merge_performance
from assayspark.operators.groups import group_tests_by_factor
from assayspark.operators.longitudinal import VALUE, longitudinal, mean_sd_ratio, subject_deviations
from assayspark.operators.paired import paired_biomarkers, paired_wide
from assayspark.operators.replicates import (
    EXPERIMENT_PEPTIDE, peptide_concentrations, replicate_cv, replicate_means, rt_report, tidify,
)
from assayspark.operators.reshape import union_sets
from assayspark.operators.scale import cut_lineage

PEPTIDE = ["protein", "peptide"]
FACTORS = ["histology", "condition", "tese"]


def sample_set_study(
    sets: Iterable[DataFrame], info: DataFrame, factors: list[str] = FACTORS, alpha: float = 0.05
) -> dict[str, DataFrame]:
    """Prepared long sets to concentrations, precision and retention reports, group tests and time courses."""
    tidy = cut_lineage(union_sets(*[tidify(s) for s in sets]))
    means = replicate_means(tidy)
    concentrations = cut_lineage(peptide_concentrations(means, info, ordered=False))
    order = [f"-{VALUE}", *EXPERIMENT_PEPTIDE]
    longit = longitudinal(concentrations, "subject_id", ["peptide"], "timepoint", order, study=tidy)
    ratios = subject_deviations(concentrations, "subject_id", ["peptide"], "timepoint", order, study=tidy)
    return {
        "tidy": tidy,
        "replicate_means": means,
        "replicate_cv": replicate_cv(tidy),
        "concentrations": concentrations,
        "retention_times": rt_report(tidy),
        "group_tests": group_tests_by_factor(concentrations, PEPTIDE, factors, "concentration_ug_ml", alpha),
        "longitudinal": longit,
        "sd_ratios": ratios,
        "mean_sd_ratios": mean_sd_ratio(ratios, ["peptide"]),
    }


def calibration_study(
    prepared: DataFrame, info: DataFrame, amounts: DataFrame, max_cv: float = 0.2
) -> dict[str, DataFrame]:
    """Prepared calibration report to retention report, curve, linear range, limits and fits."""
    tidy = cut_lineage(tidify_calibration(prepared))
    replicates = curve_replicates(tidy, info)
    ranged = cut_lineage(linear_range(curve_points(replicates, info, max_cv), amounts))
    return {
        "retention_times": rt_report(tidy, na_rm=True, as_percent=False),
        "replicates": replicates,
        "curve": ranged,
        "limits": limit_of_quantification(ranged, info),
        "fits": calibration_fit(ranged),
        "optimal_spike": optimal_spike(tidy),
    }


def biomarker_study(
    concentrations: DataFrame, subject: str, condition: str, levels: tuple[str, str], paired_value: str,
    class_column: str, class_value: str, fc: float = 1.0, alpha: float = 0.05, threshold: float = 0.5,
) -> dict[str, DataFrame]:
    """Paired statistics, one classifier per analyte and the combined score."""
    wide = paired_wide(concentrations, subject, PEPTIDE, condition, paired_value, levels)
    biomarkers = cut_lineage(paired_biomarkers(wide, PEPTIDE, fc, alpha))
    classifiers = cut_lineage(classifier_table(concentrations, PEPTIDE, class_value, class_column, threshold))
    merged = merge_performance(biomarkers, classifiers, PEPTIDE)
    return {"biomarkers": biomarkers, "classifiers": classifiers, "scores": marker_score(merged)}
