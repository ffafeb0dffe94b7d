"""Calibration curve: replicates, points, linear range, limit of quantification and fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.functions.aggregates import cv, first_row, mean
from assayspark.functions.expressions import joined_label, log10_positive, mass_concentration, ratio_or_area, transition_label
from assayspark.operators.filters import in_linear_range
from assayspark.operators.joins import lookup_first
from assayspark.operators.replicates import ISOTOPES, TRANSITION
from assayspark.operators.reshape import pivot_multi
from assayspark.operators.scale import attach

CURVE_MEASURES = ["area", "background", "retention_time", "transition_rank", "precursor_mz", "product_mz"]


def ratio_fallback(df: DataFrame, ratio: str = "lth") -> DataFrame:
    return df.withColumn(ratio, ratio_or_area(F.col(ratio), F.col("light_area"), F.col("heavy_area")))


def tidify_calibration(df: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """One row per replicate and transition, zero ratios replaced by the area ratio.

    Six measures become a heavy and a light column each; other columns come from the transition's first row.
    """
    ids = ["replicate_name", *TRANSITION]
    measures = [m for m in CURVE_MEASURES if m in df.columns]
    rest = [c for c in df.columns if c not in {"isotope", *measures, *ids}]
    wide = pivot_multi(
        df, ids, "isotope", measures, levels=ISOTOPES, rest=rest, order_by=["row_id"], on_duplicate=on_duplicate
    )
    return ratio_fallback(wide)


def with_calibration_ids(tidy: DataFrame) -> DataFrame:
    """Add the three pasted ids of a calibration row; they serve display, the columns behind them identify it."""
    transition = transition_label()
    return tidy.withColumns({
        "transition_id": F.concat_ws("_", joined_label("replicate_name"), transition),
        "experiment_id": joined_label("subject_id", "condition", sep=" "),
        "experiment_transition_id": F.concat_ws(" ", joined_label("curvepoint"), transition),
    })


def curve_replicates(tidy: DataFrame, info: DataFrame) -> DataFrame:
    """Light-to-heavy ratio and concentrations per curve point, peptide and trial; NULLs are left out."""
    averaged = tidy.groupBy("curvepoint", "peptide", "trial").agg(
        F.avg("fmol_ul").alias("fmol_ul"), F.avg("rdotp").alias("rdotp"), F.avg("lth").alias("lth")
    )
    described = lookup_first(averaged, info, "peptide", ["protein", "mw", "stage_specificity"], ["protein"])
    molar = described.withColumn("htl", F.try_divide(F.lit(1.0), F.col("lth"))).withColumns({
        "theor_h_fm_ul": F.col("fmol_ul") * F.col("curvepoint"),
        "h_concentration_fm_ul": F.col("fmol_ul") * F.col("htl"),
    })
    return molar.withColumns({
        "theor_h_ug_ml": mass_concentration(F.col("theor_h_fm_ul"), F.col("mw")),
        "h_concentration_ug_ml": mass_concentration(F.col("h_concentration_fm_ul"), F.col("mw")),
    })


def curve_points(replicates: DataFrame, info: DataFrame, max_cv: float = 0.2) -> DataFrame:
    """Heavy-to-light ratio over the trials of a curve point, with the precision verdict ``sdthr``."""
    points = replicates.groupBy("curvepoint", "peptide").agg(
        F.avg("htl").alias("mean_htl"),
        F.stddev_samp("htl").alias("sd_htl"),
        cv("htl", na_rm=True).alias("cv_htl"),
        F.avg("theor_h_ug_ml").alias("theor_h_ug_ml"),
    )
    judged = points.withColumn("sdthr", F.col("cv_htl") < F.lit(float(max_cv)))
    return lookup_first(judged, info, "peptide", ["protein", "stage_specificity"], ["protein"])


def linear_range(points: DataFrame, amounts: DataFrame) -> DataFrame:
    """Verdicts per point: ``linthr`` at or above the limit, ``sdthr`` above the last imprecise point,
    ``cthr`` both. One point of unknown precision makes the peptide's verdicts unknown.
    """
    failing = F.when(F.col("sdthr").isNotNull(), F.when(F.col("sdthr"), F.lit(0.0)).otherwise(F.col("curvepoint")))
    worst = points.groupBy("peptide").agg(
        F.when(F.count(failing) == F.count(F.lit(1)), F.max(failing)).alias("_worst")
    )
    limited = lookup_first(points, amounts, "peptide", ["linlim"], ["linlim"])
    point = F.col("curvepoint")
    return attach(limited, worst, ["peptide"]).withColumns({
        "linthr": point >= F.col("linlim"),
        "sdthr": F.when(F.col("_worst").isNull(), F.lit(None).cast("boolean"))
        .otherwise(F.when(point <= F.col("_worst"), F.lit(False)).otherwise(F.col("sdthr"))),
    }).withColumn("cthr", F.col("linthr") & F.col("sdthr")).drop("_worst", "linlim")


def limit_of_quantification(ranged: DataFrame, info: DataFrame) -> DataFrame:
    """Lowest in-range curve point and concentration per peptide."""
    lowest = in_linear_range(ranged).groupBy("peptide").agg(
        F.min("curvepoint").alias("loq_point"),
        F.when(F.count("theor_h_ug_ml") == F.count(F.lit(1)), F.min("theor_h_ug_ml")).alias("loq_ug_ml"),
    )
    return lookup_first(lowest, info, "peptide", ["protein", "stage_specificity"], ["protein"]).select(
        "protein", "peptide", "stage_specificity", "loq_point", "loq_ug_ml"
    )


def line_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least-squares line per key with R squared and adjusted R squared.

    Built from one pass of centred moments; NULL where x does not vary.
    """
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    moments = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"),
        F.var_pop(x).alias("_vx"), F.var_pop(y).alias("_vy"), F.covar_pop(x, y).alias("_cxy"),
    )
    slope = F.try_divide(F.col("_cxy"), F.col("_vx"))
    r2 = F.try_divide(F.col("_cxy") * F.col("_cxy"), F.col("_vx") * F.col("_vy"))
    return moments.withColumns({"slope": slope, "r2": r2}).select(
        *keys, "n", "slope",
        (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"),
        "r2",
        (1 - (1 - F.col("r2")) * F.try_divide((F.col("n") - 1).cast("double"), (F.col("n") - 2).cast("double")))
        .alias("adj_r2"),
    )


def calibration_fit(points: DataFrame, log: bool = False) -> DataFrame:
    """Ratio on theoretical concentration per peptide over its precise points.

    ``log`` fits log10 on log10 per peptide and verdict instead.
    """
    if not log:
        return line_fit(points.filter(F.col("sdthr")), ["peptide"], "theor_h_ug_ml", "mean_htl")
    scaled = points.select(
        "peptide", "cthr",
        log10_positive(F.col("theor_h_ug_ml")).alias("_x"), log10_positive(F.col("mean_htl")).alias("_y"),
    )
    return line_fit(scaled, ["peptide", "cthr"], "_x", "_y")


def optimal_spike(tidy: DataFrame) -> DataFrame:
    """Spike amount that would bring the endogenous ratio at curve point 1 to a third."""
    at_one = tidy.filter(F.col("curvepoint") == 1).groupBy("peptide").agg(
        first_row(["protein"], ["row_id"]).alias("_first"),
        F.avg("fmol_ug").alias("fmol_ug"), F.avg("fmol_ul").alias("fmol_ul"),
        mean("lth").alias("mean_lth"), cv("lth").alias("cv_lth"),
    )
    return at_one.select(
        "_first.protein", "peptide", "fmol_ug", "fmol_ul", "mean_lth", "cv_lth",
        F.round(F.col("fmol_ug") * F.col("mean_lth") * 3, 2).alias("opt_fmol_ug"),
    )


def curve_transition_summary(tidy: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean and variation of every measure per curve point and transition.

    Where the mean light-to-heavy ratio is 0 both ratios come from the areas.
    """
    plain = [
        f"{isotope}_{measure}" for measure in ("retention_time", "area", "background", "transition_rank")
        for isotope in ISOTOPES
    ] + ["rdotp"]
    ratios = tidy.withColumns({
        "_hl": F.try_divide(F.lit(1.0), F.col("lth")),
        "_area_lh": F.try_divide(F.col("light_area"), F.col("heavy_area")),
        "_area_hl": F.try_divide(F.col("heavy_area"), F.col("light_area")),
    })
    grouped = ratios.groupBy("curvepoint", *TRANSITION).agg(
        *[f(c).alias(f"{name}_{c}") for c in plain for name, f in (("mean", mean), ("cv", cv))],
        *[
            f(c).alias(f"_{name}_{c}")
            for c in ("lth", "_hl", "_area_lh", "_area_hl") for name, f in (("mean", mean), ("cv", cv))
        ],
        first_row(["protein", "peptide", "fmol_ul", "fmol_ug"], ["row_id"]).alias("_first"),
    )
    unreported = F.col("_mean_lth") == 0

    def settled(stat: str, reported: str, from_area: str):
        return F.when(unreported, F.col(f"_{stat}_{from_area}")).otherwise(F.col(f"_{stat}_{reported}"))

    report = grouped.select(
        "curvepoint", "_first.protein", "_first.peptide", transition_label().alias("transition_name"),
        "_first.fmol_ul", "_first.fmol_ug",
        *[f"{name}_{c}" for c in plain for name in ("mean", "cv")],
        settled("mean", "lth", "_area_lh").alias("mean_light_to_heavy"),
        settled("cv", "lth", "_area_lh").alias("cv_light_to_heavy"),
        settled("mean", "_hl", "_area_hl").alias("mean_heavy_to_light"),
        settled("cv", "_hl", "_area_hl").alias("cv_heavy_to_light"),
    )
    return report.orderBy(F.asc_nulls_last("mean_heavy_retention_time")) if ordered else report
