"""Identity keys, isotope pivot, replicate means, peptide concentrations and retention times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.functions.aggregates import cv, first_row, mean
from assayspark.functions.expressions import (
    RUN_PATTERN, TRIAL_PATTERN, extract_int, joined_label, mass_concentration, percent,
    precursor_label, select_first, signal_to_noise, transition_label,
)
from assayspark.operators.joins import lookup_first
from assayspark.operators.reshape import pivot_multi
from assayspark.operators.scale import cut_lineage

# The columns that identify each level; pasted labels are ambiguous and serve display only.
SAMPLE = ["subject_id", "condition", "timepoint"]
EXPERIMENT = [*SAMPLE, "curvepoint", "set"]
PRECURSOR = ["peptide_mods", "precursor_charge"]
TRANSITION = [*PRECURSOR, "fragment_ion", "product_charge"]
MEASUREMENT_TRANSITION = [*EXPERIMENT, "run", *TRANSITION]
EXPERIMENT_TRANSITION = [*EXPERIMENT, *TRANSITION]
EXPERIMENT_PEPTIDE = [*EXPERIMENT, "peptide"]

ISOTOPES = ["heavy", "light"]
ISOTOPE_MEASURES = [
    "area", "background", "max_height", "transition_rank", "retention_time", "precursor_mz", "product_mz",
]
AVERAGED = [
    "heavy_retention_time", "light_retention_time", "heavy_area", "light_area", "heavy_background",
    "light_background", "heavy_max_height", "light_max_height", "rdotp", "lth",
]
ATTRIBUTES = [
    "run", "peptide", "protein", "histology", "tese", "texlevel", "fmol_ul", "loq_ug_ml", "lod",
]


def with_run_and_trial(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "run": extract_int("replicate_name", RUN_PATTERN),
        "trial": extract_int("replicate_name", TRIAL_PATTERN),
    })


def with_labels(df: DataFrame) -> DataFrame:
    """Add the eight pasted id labels."""
    sample = joined_label(*SAMPLE)
    experiment = F.concat_ws("_", sample, joined_label("curvepoint", "set"))
    measurement = F.concat_ws("_", experiment, joined_label("run"))
    transition = transition_label()
    return df.withColumns({
        "sample_label": sample,
        "experiment_label": experiment,
        "measurement_label": measurement,
        "precursor_name": precursor_label(),
        "transition_name": transition,
        "experiment_transition_label": F.concat_ws("_", experiment, transition),
        "experiment_peptide_label": F.concat_ws("_", experiment, joined_label("peptide")),
        "measurement_transition_label": F.concat_ws("_", measurement, transition),
    })


def with_spike(df: DataFrame, stock: float = 40.0) -> DataFrame:
    """Spiked amount: dimension ``fmol_ug`` times the stock concentration, over the reported one."""
    return df.withColumn("fmol_ul", F.col("fmol_ug") * F.lit(float(stock)))


def tidify(df: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """One row per measurement and transition with ``heavy_`` and ``light_`` columns."""
    measures = [m for m in ISOTOPE_MEASURES if m in df.columns]
    rest = [c for c in df.columns if c not in {"isotope", *measures, *MEASUREMENT_TRANSITION}]
    return pivot_multi(
        df, MEASUREMENT_TRANSITION, "isotope", measures, levels=ISOTOPES, rest=rest,
        order_by=["row_id"], on_duplicate=on_duplicate,
    )


def replicate_means(tidy: DataFrame) -> DataFrame:
    """Means over the replicates of a transition; NULL if a replicate lacks the measure.

    Descriptive columns come from the first replicate.
    """
    carried = ["heavy_transition_rank", *ATTRIBUTES, "row_id"]
    averaged = tidy.groupBy(*EXPERIMENT_TRANSITION).agg(
        *[mean(c).alias(c) for c in AVERAGED],
        first_row([c for c in carried if c in tidy.columns], ["row_id"]).alias("_first"),
    )
    return averaged.select(*EXPERIMENT_TRANSITION, *AVERAGED, "_first.*")


def replicate_cv(tidy: DataFrame, as_percent: bool = True) -> DataFrame:
    """Coefficient of variation of each measure over the replicates of a transition."""
    spread = tidy.groupBy(*EXPERIMENT_TRANSITION).agg(*[cv(c).alias(c) for c in AVERAGED])
    return spread.withColumns({c: percent(F.col(c)) for c in AVERAGED}) if as_percent else spread


def relative_to_max(df: DataFrame, column: str, out: str, na_rm: bool = False) -> DataFrame:
    """Column over its maximum across the table; NULL reads 1.

    Unless ``na_rm``, a single NULL makes the maximum unknown and blanks the other rows. The maximum is a scalar of the plan;
    nothing is written.
    """
    largest = F.max(column) if na_rm else F.when(F.count(column) == F.count(F.lit(1)), F.max(column))
    peak = df.select(largest).scalar()
    ratio = F.try_divide(F.col(column), peak)
    return df.withColumn(out, F.when(F.col(column).isNull(), F.lit(1.0)).otherwise(ratio))


def peptide_concentrations(
    means: DataFrame, info: DataFrame, na_rm_relative: bool = False, ordered: bool = True
) -> DataFrame:
    """One row per experiment and peptide from its rank-1 transitions.

    Signal to noise, retention-time shift and concentration; the attributes come from the first
    measurement of the peptide, whatever its rank, in the same aggregation.
    """
    quantifier = F.col("heavy_transition_rank") == 1
    attributes = [c for c in ATTRIBUTES if c != "peptide"]

    def over_quantifiers(column: str):
        present = F.count(F.when(quantifier, F.col(column)))
        return F.when(present == F.count(F.when(quantifier, 1)), F.avg(F.when(quantifier, F.col(column))))

    grouped = means.groupBy(*EXPERIMENT_PEPTIDE).agg(
        F.count(F.when(quantifier, 1)).alias("_quantifiers"),
        *[over_quantifiers(c).alias(c) for c in AVERAGED],
        first_row(attributes, ["row_id"]).alias("_first"),
    ).filter(F.col("_quantifiers") > 0)
    flat = grouped.select(*EXPERIMENT_PEPTIDE, *AVERAGED, "_first.*").withColumns({
        "lh_rt_diff": F.abs(F.col("light_retention_time") - F.col("heavy_retention_time")),
        "heavy_snr": signal_to_noise(F.col("heavy_area"), F.col("heavy_background")),
        "light_snr": signal_to_noise(F.col("light_area"), F.col("light_background")),
        "concentration_fm_ul": F.col("lth") * F.col("fmol_ul"),
    }).drop("protein", "heavy_area", "light_area", "heavy_retention_time", "light_retention_time")
    described = lookup_first(flat, info, "peptide", ["protein", "mw", "stage_specificity"], ["protein"])
    weighed = described.withColumnRenamed("mw", "molecular_weight").withColumn(
        "concentration_ug_ml",
        mass_concentration(F.col("concentration_fm_ul"), F.col("molecular_weight")),
    )
    # One row per experiment and peptide: to write these is less than to work them out again for the maximum.
    related = relative_to_max(cut_lineage(weighed), "lh_rt_diff", "lh_rt_diff_rel", na_rm_relative)
    led = select_first(related, [
        "set", "run", "peptide", "protein", "stage_specificity", "subject_id", "condition", "histology",
        "tese", "texlevel", "rdotp", "concentration_fm_ul", "concentration_ug_ml",
    ])
    return sort_concentration(led) if ordered else led


def sort_concentration(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("peptide"), F.desc_nulls_last("concentration_ug_ml"))


def rt_report(tidy: DataFrame, na_rm: bool = False, as_percent: bool = True, ordered: bool = True) -> DataFrame:
    """Mean and variation of the heavy and light retention times per precursor."""
    heavy, light = "heavy_retention_time", "light_retention_time"
    report = tidy.groupBy(*PRECURSOR).agg(
        mean(heavy, na_rm).alias(f"mean_{heavy}"),
        cv(heavy, na_rm).alias(f"cv_{heavy}"),
        mean(light, na_rm).alias(f"mean_{light}"),
        cv(light, na_rm).alias(f"cv_{light}"),
        first_row(["protein", "peptide"], ["row_id"]).alias("_first"),
    )
    named = report.select(
        precursor_label().alias("precursor_name"), "_first.protein", "_first.peptide",
        f"mean_{heavy}",
        (percent(F.col(f"cv_{heavy}")) if as_percent else F.col(f"cv_{heavy}")).alias(f"cv_{heavy}"),
        f"mean_{light}",
        (percent(F.col(f"cv_{light}")) if as_percent else F.col(f"cv_{light}")).alias(f"cv_{light}"),
        F.abs(F.col(f"mean_{heavy}") - F.col(f"mean_{light}")).alias("mean_lh_rt_diff"),
    )
    return named.orderBy(F.asc_nulls_last(f"mean_{heavy}")) if ordered else named
