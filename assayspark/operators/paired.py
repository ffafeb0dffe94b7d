"""Before/after comparison per analyte: t test, signed ranks, power, fold change and volcano flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.functions.aggregates import mean, sd
from assayspark.functions.expressions import fold_change, hyperbolic_threshold, log2_positive
from assayspark.functions.tails import (
    paired_t_power, paired_t_sample_size, paired_t_smallest, signed_rank_tail, t_tail,
)
from assayspark.operators.groups import p_adjust_bh
from assayspark.operators.joins import lookup_first
from assayspark.operators.reshape import pivot_multi
from assayspark.operators.scale import average_ranks, cut_lineage, null_safe_join

EXACT_BELOW = 50


def paired_wide(
    df: DataFrame, subject: str, analyte: list[str], condition: str, value: str,
    levels: tuple[str, str] = ("PRE", "POST"), on_duplicate: str = "error",
) -> DataFrame:
    """One row per subject and analyte with both conditions and their ratio ``fc``."""
    pre, post = levels
    wide = pivot_multi(
        df, [subject, *analyte], condition, [value], levels=[pre, post], rename=False, on_duplicate=on_duplicate
    ).withColumnsRenamed({pre: "pre", post: "post"})
    return wide.withColumn("fc", fold_change(F.col("pre"), F.col("post")))


def paired_summary(wide: DataFrame, analyte: list[str]) -> DataFrame:
    """Means, deviations, count, pooled deviation, errors and mean fold change per analyte.

    ``se`` is sd over the root of n; ``se_ref`` is sd over n, as some published tables have it.
    """
    grouped = wide.groupBy(*analyte).agg(
        F.count(F.lit(1)).alias("n"),
        mean("pre").alias("mean_pre"), mean("post").alias("mean_post"),
        sd("pre").alias("sd_pre"), sd("post").alias("sd_post"), mean("fc").alias("mean_fc"),
    )
    n = F.col("n").cast("double")
    return grouped.withColumns({
        "sd_pooled": F.sqrt((F.col("sd_pre") * F.col("sd_pre") + F.col("sd_post") * F.col("sd_post")) / 2),
        "se_pre": F.col("sd_pre") / F.sqrt(n), "se_post": F.col("sd_post") / F.sqrt(n),
        "se_ref_pre": F.col("sd_pre") / n, "se_ref_post": F.col("sd_post") / n,
        "log2_fc": log2_positive(F.col("mean_fc")),
    })


def _difference() -> Column:
    return F.col("pre") - F.col("post")


def paired_t(wide: DataFrame, analyte: list[str], alternative: str = "greater") -> DataFrame:
    """Paired t test over complete pairs, with Cohen's d of the differences."""
    tested = wide.groupBy(*analyte).agg(
        F.count(_difference()).alias("pairs"), F.count(F.lit(1)).alias("_n"),
        F.avg(_difference()).alias("_mean"), F.stddev_samp(_difference()).alias("_sd"),
    )
    standard_error = F.col("_sd") / F.sqrt(F.col("pairs").cast("double"))
    freedom = (F.col("pairs") - 1).cast("double")
    t = F.col("t")
    scored = tested.withColumn("t", F.try_divide(F.col("_mean"), standard_error))
    if alternative == "two.sided":
        p = 2 * t_tail(F.abs(t), freedom)
    else:
        p = t_tail(t if alternative == "greater" else -t, freedom)
    return scored.withColumn("p", p).select(
        *analyte, "pairs", (F.col("pairs") - 1).alias("df"), "t", "p",
        (t / F.sqrt(F.col("_n").cast("double"))).alias("cohen_d"),
    )


def wilcoxon_signed_rank(wide: DataFrame, analyte: list[str]) -> DataFrame:
    """Two-sided signed-rank test: exact below 50 untied non-zero differences, else normal."""
    differences = wide.select(*analyte, _difference().alias("_d")).filter(F.col("_d").isNotNull())
    zeros = differences.groupBy(*analyte).agg(F.count(F.when(F.col("_d") == 0, 1)).alias("zeros"))
    sized = differences.filter(F.col("_d") != 0).select(
        *analyte, F.abs("_d").alias("_size"), F.when(F.col("_d") > 0, 1).otherwise(0).alias("_up")
    )
    ranked = average_ranks(sized, analyte, "_size", counts=["_up"])
    tied = F.col("n").cast("double")
    sums = ranked.groupBy(*analyte).agg(
        F.sum(F.col("rank") * F.col("_up")).alias("v"), F.sum("n").alias("n"),
        F.sum(tied * tied * tied - tied).alias("_ties"),
    )
    joined = null_safe_join(zeros, sums, analyte)
    exact = (F.col("n") < EXACT_BELOW) & (F.col("_ties") == 0) & (F.col("zeros") == 0)
    p = signed_rank_tail(F.col("v"), F.col("n").cast("double"), F.col("_ties"), exact.cast("double"))
    return joined.withColumns({"exact": exact, "p": p}).select(*analyte, "n", "zeros", "v", "exact", "p")


def volcano_flag(log2_fc: Column, p: Column, fc: float = 1.0, alpha: float = 0.05, symmetric: bool = False) -> Column:
    """Fold change beyond the limit and p above the hyperbolic threshold."""
    height = F.when(p > 0, -F.log10(p)).when(p == 0, F.lit(float("inf")))
    limit = hyperbolic_threshold(log2_fc, fc, alpha, symmetric=symmetric)
    return (F.abs(log2_fc) > F.lit(float(fc))) & (height > limit)


def volcano_flags(table: DataFrame, fc: float = 1.0, alpha: float = 0.05, symmetric: bool = False) -> DataFrame:
    """Flags for the raw t test p, its adjusted p and the adjusted signed-rank p."""
    return table.withColumns({
        out: volcano_flag(F.col("log2_fc"), F.col(p), fc, alpha, symmetric)
        for out, p in (("flag_t", "p_t"), ("flag_bh", "p_bh"), ("flag_u_bh", "p_u_bh"))
    })


def paired_described(table: DataFrame, info: DataFrame, key: str = "peptide", columns: list[str] | None = None) -> DataFrame:
    """A paired table with the protein and stage of its analytes in front, from the first row of each in ``info``."""
    columns = columns or ["protein", "stage_specificity"]
    described = lookup_first(table, info, key, columns, columns)
    return described.select(*columns, *table.columns)


def paired_biomarkers(
    wide: DataFrame, analyte: list[str], fc: float = 1.0, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Every paired statistic per analyte as one table.

    ``n_at_power`` is the size at which a paired t test has ``power``, ``pairs_needed`` the smallest whole number of pairs that reaches it.
    The pairs and the table of analytes are written once: several statistics read the pairs, and both adjustments the table.
    """
    wide = cut_lineage(wide)
    t_test = paired_t(wide, analyte).select(*analyte, "t", F.col("p").alias("p_t"), "cohen_d")
    u_test = wilcoxon_signed_rank(wide, analyte).select(*analyte, F.col("v"), F.col("p").alias("p_u"))
    joined = cut_lineage(null_safe_join(null_safe_join(paired_summary(wide, analyte), t_test, analyte), u_test, analyte))
    adjusted = p_adjust_bh(p_adjust_bh(joined, "p_t", out="p_bh"), "p_u", out="p_u_bh")
    powered = adjusted.withColumns({
        "power": paired_t_power(F.col("n").cast("double"), F.col("cohen_d"), F.lit(float(alpha))),
        "pairs_needed": paired_t_smallest(F.col("cohen_d"), F.lit(float(power)), F.lit(0.05)).cast("bigint"),
        "n_at_power": F.round(paired_t_sample_size(F.col("cohen_d"), F.lit(float(power)), F.lit(0.05)), 1),
    })
    return volcano_flags(powered, fc, alpha).select(
        *analyte, "n", "mean_fc", "log2_fc", "mean_pre", "mean_post", "sd_pre", "sd_post", "sd_pooled",
        "se_pre", "se_post", "se_ref_pre", "se_ref_post", "t", "p_t", "p_bh", "cohen_d", "power", "n_at_power", "pairs_needed",
        "flag_t", "flag_bh", "v", "p_u", "p_u_bh", "flag_u_bh",
    )
