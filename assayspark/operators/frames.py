"""Data behind the study's plots; drawing is left to the user's plotting library."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.functions.expressions import hyperbolic_threshold, log10_positive, logistic, normal_quantile
from assayspark.operators.calibration import line_fit
from assayspark.operators.filters import drop_unknown, limit_categories
from assayspark.operators.scale import attach, cut_lineage, in_slices, null_safe_join, running

VALUE = "concentration_ug_ml"
DOT_PRODUCT_RANGE = (0.2, 1.3)
COPIES_PER_TASK = 100_000


def lod_frame(concentrations: DataFrame, value: str = VALUE) -> DataFrame:
    """Points of the detection plot: concentration against dot product, with ``above_lod``."""
    low, high = DOT_PRODUCT_RANGE
    shown = concentrations.filter((F.col(value) > 0) & F.col("rdotp").between(low, high))
    return shown.select(
        "peptide", "protein", "stage_specificity", "run", value, "rdotp", "lh_rt_diff", "lod",
        (F.col(value) > F.col("lod")).alias("above_lod"),
    )


def lod_override(
    concentrations: DataFrame, run: int, rule: int = 0, value: str = VALUE, max_shift: float = 0.05
) -> DataFrame:
    """New detection limit per peptide: the concentration found in the chosen run.

    ``labelled`` marks no point (rule 0), all (1), points at the old or new limit (2), and points
    with a small retention-time shift too (3). Several values in the run give the lowest.
    """
    chosen = concentrations.filter(F.col("run") == run).groupBy("peptide").agg(F.min(value).alias("new_lod"))
    joined = attach(concentrations, chosen, ["peptide"])
    at_limit = (F.round(value, 4) == F.round("lod", 4)) | (F.col(value) == F.col("new_lod"))
    label = {
        0: F.lit(False), 1: F.lit(True), 2: at_limit, 3: at_limit | (F.col("lh_rt_diff") < max_shift),
    }[rule]
    return joined.select(
        "peptide", "run", value, "rdotp", "lh_rt_diff", "lod", "new_lod",
        F.coalesce(label, F.lit(False)).alias("labelled"),
    )


def _positive_logs(df: DataFrame, analyte: list[str], category: str, value: str, categories) -> DataFrame:
    known = drop_unknown(df, category)
    if categories:
        known = limit_categories(known, category, categories)
    return known.select(*analyte, category, log10_positive(F.col(value)).alias("_log")).filter(F.col("_log").isNotNull())


def grouped_quartiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean and exact quartiles (linear interpolation) per key.

    Quartiles are picked by position from running counts over distinct values, so a large group
    never sits in one buffer.
    """
    tallied = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(
        in_slices(tallied, keys, [value]), keys, [value], sums={"_upto": "_n"}, totals={"_all": "_n"}
    )
    picks = []
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        position = (F.col("_all") - 1) * share
        for end, index in (("low", F.floor(position)), ("high", F.ceil(position))):
            here = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{end}"))
    found = placed.groupBy(*keys).agg(
        F.sum("_n").alias("n"), (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("mean"), *picks
    )

    def between(name: str, share: float):
        position = (F.col("n") - 1) * share
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    return found.select(*keys, "n", "mean", between("q1", 0.25), between("median", 0.5), between("q3", 0.75))


def strip_summary(
    df: DataFrame, analyte: list[str], category: str, value: str = VALUE, categories: list[str] | None = None,
    lod: str | None = None,
) -> DataFrame:
    """Box per analyte and category on the log10 scale: count, mean, quartiles, whiskers, outliers.

    ``lod`` names the column with the analyte's detection limit, the plot's horizontal line; its largest value is added as ``lod``.
    """
    keys = [*analyte, category]
    if lod:
        limits = cut_lineage(df.groupBy(*analyte).agg(F.max(lod).alias("lod")))
        return null_safe_join(strip_summary(df, analyte, category, value, categories), limits, analyte)
    logs = cut_lineage(_positive_logs(df, analyte, category, value, categories))
    boxes = cut_lineage(grouped_quartiles(logs, keys, "_log"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_log").between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = attach(logs, boxes.select(*keys, "q1", "q3"), keys).groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_log"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_log"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return null_safe_join(boxes, whiskers, keys).withColumn(
        "geometric_mean", F.pow(F.lit(10.0), F.col("mean"))
    )


def strip_outliers(
    df: DataFrame, analyte: list[str], category: str, value: str = VALUE, categories: list[str] | None = None
) -> DataFrame:
    """The points beyond the whiskers, on the log10 scale."""
    keys = [*analyte, category]
    logs = cut_lineage(_positive_logs(df, analyte, category, value, categories))
    boxes = grouped_quartiles(logs, keys, "_log").select(*keys, "q1", "q3")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = attach(logs, boxes, keys)
    return joined.filter(~F.col("_log").between(F.col("q1") - reach, F.col("q3") + reach)).select(
        *keys, F.col("_log").alias("log10_value")
    )


def correlation_frame(correlations: DataFrame, digits: int = 2) -> DataFrame:
    return correlations.withColumn("correlation", F.round("correlation", digits))


def density_histogram(df: DataFrame, value: str, binwidth: float = 1.0) -> DataFrame:
    """Density per bin centred on multiples of the width, with the normal density at its centre."""
    bins = df.filter(F.col(value).isNotNull()).groupBy(
        F.ceil(F.col(value) / binwidth - 0.5).cast("bigint").alias("bin")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("_mean"),
        (F.var_pop(value) * F.count(F.lit(1))).alias("_ss"),
    )
    kept = cut_lineage(bins)
    total = kept.select(F.sum("n")).scalar()
    centre = kept.select(F.sum(F.col("n") * F.col("_mean")) / F.sum("n")).scalar()
    placed = cut_lineage(kept.withColumns({"_total": total, "_centre": centre}))
    spread = placed.select(F.sqrt(F.try_divide(
        F.sum(F.col("_ss") + F.col("n") * (F.col("_mean") - F.col("_centre")) * (F.col("_mean") - F.col("_centre"))),
        F.first("_total") - 1.0,
    ))).scalar()
    scored = placed.withColumns({"bin_centre": F.col("bin") * F.lit(float(binwidth)), "sd": spread})
    z = F.try_divide(F.col("bin_centre") - F.col("_centre"), F.col("sd"))
    return scored.select(
        "bin", "bin_centre", "n",
        (F.col("n") / (F.col("_total") * F.lit(float(binwidth)))).alias("density"),
        F.col("_centre").alias("mean"), "sd",
        F.try_divide(F.exp(-z * z / 2), F.col("sd") * math.sqrt(2 * math.pi)).alias("normal_density"),
    )


def qq_frame(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Every value with its place, plotting position and normal quantile, per group.

    Equal values are tallied, placed once and copied out in chunks, so neither a large group nor a
    frequent value sits in one task.
    """
    keys = group or []
    tallied = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    placed = running(
        in_slices(tallied, keys, ["value"]), keys, ["value"], sums={"_upto": "_n"}, totals={"_all": "_n"}
    )
    chunks = placed.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPIES_PER_TASK)))
    ).repartition(*keys, "value", "_chunk")
    start = F.col("_upto") - F.col("_n") + 1 + F.col("_chunk") * COPIES_PER_TASK
    end = F.least(F.col("_upto"), start + (COPIES_PER_TASK - 1))
    copied = chunks.withColumn("place", F.explode(F.sequence(start, end)))
    shift = F.when(F.col("_all") <= 10, F.lit(0.375)).otherwise(F.lit(0.5))
    positioned = copied.withColumn("p", (F.col("place") - shift) / (F.col("_all") + 1 - 2 * shift))
    return positioned.withColumn("theoretical", normal_quantile(F.col("p"))).select(*keys, "place", "value", "p", "theoretical")


def curve_frame(points: DataFrame) -> DataFrame:
    """Curve points with error bars and the log-log line of their verdict."""
    logs = points.select(
        "peptide", "cthr", log10_positive(F.col("theor_h_ug_ml")).alias("_x"),
        log10_positive(F.col("mean_htl")).alias("_y"),
    )
    lines = line_fit(logs, ["peptide", "cthr"], "_x", "_y").select("peptide", "cthr", "slope", "intercept")
    return attach(points, lines, ["peptide", "cthr"]).select(
        "peptide", "curvepoint", "theor_h_ug_ml", "mean_htl",
        (F.col("mean_htl") - F.col("sd_htl")).alias("lower"), (F.col("mean_htl") + F.col("sd_htl")).alias("upper"),
        "cthr", F.col("slope").alias("line_slope"), F.col("intercept").alias("line_intercept"),
    )


def timepoint_frame(longit: DataFrame, subject: str, analyte: list[str], timepoint: str) -> DataFrame:
    return longit.select(subject, *analyte, timepoint, "concentration_r").orderBy(subject, *analyte, timepoint)


def volcano_frame(table: DataFrame, analyte: list[str], p: str = "p_bh", flag: str = "flag_bh") -> DataFrame:
    """Points of the volcano plot."""
    return table.select(
        *analyte, "log2_fc", F.when(F.col(p) > 0, -F.log10(F.col(p))).alias("neg_log10_p"), F.col(flag).alias("flag")
    )


def volcano_curve(
    table: DataFrame, low: float = 1.0, high: float = 10.0, steps: int = 100, fc: float = 1.0, alpha: float = 0.05
) -> DataFrame:
    """Threshold curve of the volcano plot on an even grid."""
    grid = table.sparkSession.range(steps + 1).select(
        (F.lit(low) + F.col("id") * ((high - low) / steps)).alias("log2_fc")
    )
    return grid.withColumn("threshold", hyperbolic_threshold(F.col("log2_fc"), fc, alpha))


def volcano_plot(
    table: DataFrame, analyte: list[str], label: str, p: str = "p_bh", flag: str = "flag_bh", low: float = 1.0, high: float = 10.0,
    steps: int = 100, fc: float = 1.0, alpha: float = 0.05,
) -> DataFrame:
    """The whole volcano plot as one frame: ``kind`` is ``point`` or ``curve``.

    Points carry their analyte, flag and ``text``, the label of every point; the curve is the threshold on an even grid, without these.
    """
    points = volcano_frame(table, analyte, p, flag)
    named = null_safe_join(points, table.select(*analyte, F.col(label).alias("text")), analyte).withColumn("kind", F.lit("point"))
    curve = volcano_curve(table, low, high, steps, fc, alpha).select(
        F.lit("curve").alias("kind"), "log2_fc", F.col("threshold").alias("neg_log10_p")
    )
    return named.unionByName(curve, allowMissingColumns=True)


def logistic_plot(
    df: DataFrame, fits: DataFrame, analyte: list[str], x: str, y: str, steps: int = 100
) -> DataFrame:
    """Observed points (``kind`` point) and the fitted line (``kind`` line) on an even grid from the smallest to the largest x.

    An analyte without a fit has no line.
    """
    points = logistic_frame(df, fits, analyte, x, y).withColumn("kind", F.lit("point"))
    ends = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*analyte).agg(
        F.min(x).cast("double").alias("_low"), F.max(x).cast("double").alias("_high")
    )
    known = null_safe_join(ends, fits.filter(F.col("slope").isNotNull()), analyte, "inner")
    grid = known.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    at = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_step") / steps
    line = grid.select(
        *analyte, at.alias(x), logistic(F.col("intercept"), F.col("slope"), at).alias("fitted"), "cutoff", F.lit("line").alias("kind"),
    )
    return points.unionByName(line, allowMissingColumns=True)


def logistic_frame(
    df: DataFrame, fits: DataFrame, analyte: list[str], x: str, y: str
) -> DataFrame:
    """Observed points with the fitted probability and the cut-off of their analyte."""
    joined = attach(df.select(*analyte, x, y), fits.select(*analyte, "intercept", "slope", "cutoff"), analyte)
    return joined.withColumn(
        "fitted", logistic(F.col("intercept"), F.col("slope"), F.col(x))
    ).drop("intercept", "slope")
