"""Registered queries: every operator over the given tables.

Doubles are rounded so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from assayspark.functions import expressions as X
from assayspark.functions.aggregates import mean
from assayspark.operators import calibration as C
from assayspark.operators import classify as L
from assayspark.operators import frames as P
from assayspark.operators import groups as T
from assayspark.operators import longitudinal as W
from assayspark.operators import paired as B
from assayspark.operators import reshape as R
from assayspark.operators.correlation import cross_correlation as correlate
from assayspark.operators.filters import (
    above_lod as keep_above_lod, complete_subjects as keep_complete, condition_subset as keep_conditions,
    drop_unknown, limit_categories,
)
from assayspark.operators.ingest import tag_set
from assayspark.operators.joins import drop_botched, enrich_left as join_dimension, lookup_first as join_first
from assayspark.operators.ranks import rank_avg as rank_values, rank_sum as sum_ranks
from assayspark.operators.replicates import (
    AVERAGED, ISOTOPE_MEASURES, ISOTOPES, peptide_concentrations as concentrate, relative_to_max as relate,
    replicate_cv as vary, replicate_means as average, rt_report as report_times, sort_concentration, tidify as widen,
    with_labels, with_run_and_trial, with_spike,
)
from assayspark.plans import tables as V

ALPHA = 0.5
SMALL_FOLD = 0.01
TOLERANCE = 1e-12
#: Splits the curve points of the given tables into precise and imprecise ones.
MAX_CV = 0.06
BRAND = ["peptide"]
LANGUAGE = ["lang"]
EXPERIMENT_OUT = ["subject_id", "condition", "timepoint", "curvepoint"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame, digits: int = 6, nudge: float = 0.0, binary: bool = False, **special: int) -> DataFrame:
    """Doubles rounded (0 without sign), integers as bigint. A nudge settles exact ties.

    ``binary`` rounds the double times a power of ten, as SQL does, and not its decimal text: shares of counts meet ties of the text.
    """
    cast = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, DoubleType) and binary:
            power = F.lit(10.0 ** special.get(field.name, digits))
            cast[field.name] = F.round(F.col(field.name) * power, 0) / power + F.lit(0.0)
        elif isinstance(field.dataType, DoubleType):
            cast[field.name] = F.round(
                F.col(field.name) + nudge if nudge else F.col(field.name), special.get(field.name, digits)
            ) + F.lit(0.0)
        elif isinstance(field.dataType, IntegerType):
            cast[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(cast)


# Assay shape: pivot, replicates, concentrations

def tidy_view(spark, sf):
    return widen(V.assay_long(spark, sf))


def concentration_view(spark, sf):
    return concentrate(average(tidy_view(spark, sf)), V.peptide_info(spark, sf), ordered=False)


@query
def tidify(spark, sf):
    wide = with_labels(tidy_view(spark, sf))
    measures = [f"{i}_{m}" for i in ISOTOPES for m in ISOTOPE_MEASURES]
    return plain(wide.select("measurement_transition_label", "protein", "replicate_name", "lth", "rdotp", *measures))


@query
def pivot_single(spark, sf):
    return plain(R.pivot_multi(
        V.table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", ["l_extendedprice"], levels=["A", "N", "R"],
        rename=False, on_duplicate="mean",
    ))


@query
def pivot_levels(spark, sf):
    orders = V.table(spark, sf, "orders")
    return plain(R.pivot_multi(
        orders, ["o_custkey"], "o_orderstatus", ["o_totalprice", "o_orderkey"],
        levels=R.pivot_levels(orders, "o_orderstatus"), camel=True, on_duplicate="mean",
    ))


@query
def unpivot(spark, sf):
    part = V.table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), "p_retailprice")
    return plain(R.unpivot(part, ["p_partkey"], ["size", "p_retailprice"], "measure", "value"))


@query
def normalise_columns(spark, sf):
    from assayspark.sources.reports import normalise_columns as rename

    raw = V.table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "Supplier Key", "s_acctbal": "Acct.Balance"})
    return plain(rename(raw, {"Supplier.Key": "supplier_key", "Acct.Balance": "balance"}).drop("s_name"))


@query
def load_assay_set(spark, sf):
    from assayspark.operators.ingest import prepare_assay_set

    report = V.assay_report(spark, sf).drop("set", "run")
    botched = V.table(spark, sf, "region").select(
        F.lit("tables").alias("set"), (F.col("r_regionkey") + 4).alias("run")
    )
    loaded = with_labels(prepare_assay_set(
        report, V.peptide_info(spark, sf), V.peptide_amounts(spark, sf), "tables", botched
    ))
    return plain(loaded.select(
        "measurement_transition_label", "isotope", "set", "run", "trial", "protein", "area", "background",
        "max_height", "lth", "rdotp", "transition_rank", "retention_time", "fmol_ug", "fmol_ul", "loq_ug_ml", "lod",
    ))


@query
def fill_defaults(spark, sf):
    items = V.table(spark, sf, "lineitem")
    return plain(X.fill_defaults(items.select(
        "l_orderkey", "l_partkey", F.nullif("l_extendedprice", F.lit(0.0)).alias("area"),
        F.nullif("l_tax", F.lit(0.08)).alias("background"), F.nullif("l_discount", F.lit(0.05)).alias("lth"),
        F.nullif("l_tax", F.lit(0.01)).alias("rdotp"), F.nullif("l_quantity", F.lit(7.0)).alias("max_height"),
        F.nullif("l_linenumber", F.lit(7)).alias("transition_rank"),
        F.nullif("l_quantity", F.lit(1.0)).alias("retention_time"),
    )))


@query
def ratio_fallback(spark, sf):
    items = V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.nullif("l_discount", F.lit(0.05)).alias("lth"),
        F.col("l_tax").alias("light_area"), (F.col("l_quantity") - 1).alias("heavy_area"),
    )
    return plain(C.ratio_fallback(items))


@query
def extract_run(spark, sf):
    name = F.when(F.col("l_returnflag") == "N", F.lit("x_rep")).otherwise(
        F.concat(F.col("l_suppkey").cast("string"), F.lit("_S_rep"), F.col("l_linenumber").cast("string"))
    )
    named = V.table(spark, sf, "lineitem").select("l_orderkey", name.alias("replicate_name"))
    return with_run_and_trial(named).drop("trial")


@query
def extract_trial(spark, sf):
    name = F.when(F.col("l_returnflag") == "N", F.lit("12_rep")).otherwise(
        F.concat(F.lit("12_S_rep"), F.col("l_linenumber").cast("string"), F.lit("x"))
    )
    named = V.table(spark, sf, "lineitem").select("l_orderkey", name.alias("replicate_name"))
    return with_run_and_trial(named).drop("run")


@query
def extract_curve_point(spark, sf):
    number, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    between = F.when(F.col("p_size") % 3 == 0, "_").when(F.col("p_size") % 3 == 1, "__").otherwise("")
    parts = V.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("a_P"), size, between, number, F.lit("-1")).alias("replicate_name")
    )
    return plain(parts.withColumn("curvepoint", X.extract_curve_point("replicate_name")))


@query
def composite_keys(spark, sf):
    report = V.assay_report(spark, sf).withColumn("subject_id", F.nullif("subject_id", F.lit("3")))
    return with_labels(report).select(
        "row_id", "sample_label", "experiment_label", "measurement_label", "precursor_name", "transition_name",
        "experiment_transition_label", "experiment_peptide_label", "measurement_transition_label",
    )


@query
def select_first(spark, sf):
    return plain(X.select_first(V.table(spark, sf, "supplier"), ["s_acctbal", "s_name"]))


@query
def firstcap(spark, sf):
    return V.table(spark, sf, "part").select("p_partkey", X.firstcap("p_name").alias("capped"))


@query
def percent(spark, sf):
    share = F.when(F.col("l_tax") > 0, F.col("l_discount") + F.col("l_tax"))
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", X.percent(share).alias("share"))


@query
def spike_concentration(spark, sf):
    parts = V.table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("fmol_ug"))
    return plain(with_spike(parts))


@query
def signal_to_noise(spark, sf):
    means = average(tidy_view(spark, sf))
    return plain(means.groupBy("peptide").agg(
        F.avg(X.signal_to_noise(F.col("heavy_area"), F.col("heavy_background"))).alias("heavy_snr"),
        F.avg(X.signal_to_noise(F.col("light_area"), F.col("light_background"))).alias("light_snr"),
    ))


@query
def to_concentration(spark, sf):
    parts = V.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    items = V.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_discount").join(parts, "l_partkey")
    molar = items.withColumn("concentration_fm_ul", F.col("l_discount") * F.col("p_size") * 40.0)
    return plain(molar.select(
        "l_orderkey", "l_partkey", "concentration_fm_ul",
        X.mass_concentration(F.col("concentration_fm_ul"), F.col("p_retailprice")).alias("concentration_ug_ml"),
    ))


@query
def hyperbolic_threshold(spark, sf):
    x = F.log2("l_quantity") - F.col("l_linenumber") / 2
    return plain(V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", X.hyperbolic_threshold(x).alias("threshold"),
        X.hyperbolic_threshold(x, symmetric=True).alias("symmetric_threshold"),
    ))


@query
def recode_labels(spark, sf):
    merged = X.recode(F.col("c_mktsegment"), {"BUILDING": "FURNITURE", "MACHINERY": "FURNITURE"})
    return plain(V.table(spark, sf, "customer").select(
        "c_custkey", merged.alias("segment"), X.binary_class(merged, "FURNITURE").alias("label"),
    ))


@query
def floor_zero(spark, sf):
    return plain(V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", X.floor_zero(F.col("l_discount")).alias("floored"),
    ))


@query
def logit_cutoff(spark, sf):
    return plain(V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", X.logit_cutoff(F.col("l_quantity"), F.col("l_tax"), 0.7).alias("cutoff"),
    ))


# Filters and joins

@query
def drop_botched_runs(spark, sf):
    botched = V.table(spark, sf, "supplier").filter("s_acctbal < 2000").select(
        F.lit("tables").alias("set"), F.col("s_suppkey").alias("run")
    )
    rows = tag_set(V.table(spark, sf, "lineitem"), "tables").select(
        "set", "l_orderkey", "l_extendedprice", F.when(F.col("l_linenumber") < 7, F.col("l_suppkey")).alias("run")
    )
    return plain(drop_botched(rows, botched))


@query
def quantifier_only(spark, sf):
    kept = tidy_view(spark, sf).filter(F.col("heavy_transition_rank") == 1)
    return plain(kept.groupBy("peptide").agg(F.count(F.lit(1)).alias("n"), F.avg("heavy_area").alias("heavy_area")))


@query
def drop_unknown_group(spark, sf):
    rows = V.group_values(spark, sf).select(
        F.when(F.col("segment") != "BUILDING", F.col("priority")).alias("priority"), "peptide", "value"
    )
    return plain(drop_unknown(rows, "priority"))


@query
def category_limits(spark, sf):
    return plain(limit_categories(
        V.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"),
        "c_mktsegment", ["MACHINERY", "BUILDING", "absent"],
    ))


@query
def condition_subset(spark, sf):
    return keep_conditions(
        V.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
        keep=["1-URGENT", "2-HIGH", "5-LOW"], drop=["2-HIGH"],
    )


@query
def above_lod(spark, sf):
    return plain(keep_above_lod(concentration_view(spark, sf)).select(*EXPERIMENT_OUT, "peptide", "concentration_ug_ml"))


@query
def complete_subjects(spark, sf):
    return plain(keep_complete(V.followed_subjects(spark, sf), "subject_id", BRAND))


@query
def enrich_left(spark, sf):
    parts = V.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    items = V.table(spark, sf, "lineitem").select(
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")).alias("l_partkey"), "l_orderkey", "l_extendedprice"
    )
    return plain(join_dimension(items, parts, "l_partkey"))


@query
def lookup_first(spark, sf):
    suppliers = V.table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "c_nationkey")
    return plain(join_first(
        V.table(spark, sf, "customer").select("c_custkey", "c_nationkey"), suppliers, "c_nationkey",
        ["s_name", "s_acctbal"], ["s_suppkey"],
    ))


@query
def attach_group_stat(spark, sf):
    from assayspark.operators.scale import attach

    items = V.table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_quantity")
    stats = items.groupBy("l_returnflag").agg(F.stddev_samp("l_quantity").alias("total_sd"))
    return plain(attach(items, stats, ["l_returnflag"]))


# Sets, dedup, sampling

ITEM_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


@query
def distinct_first(spark, sf):
    first = R.distinct_first(V.table(spark, sf, "lineitem"), ["l_partkey"], ITEM_ORDER)
    return plain(first.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag"))


@query
def distinct_values(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("l_partkey"))
    return R.distinct_values(rows, "l_partkey")


@query
def union_sets(spark, sf):
    orders, items = V.table(spark, sf, "orders"), V.table(spark, sf, "lineitem")
    return plain(R.union_sets(
        orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price")),
        orders.filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority")),
        items.select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("price")),
    ))


@query
def set_difference(spark, sf):
    customers = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    urgent = V.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return R.set_difference(customers, urgent.select(F.col("o_custkey").alias("custkey")))


@query
def train_test_split(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return plain(R.train_test_split(orders, ["o_orderpriority"], ["o_orderkey"]))


# Replicate and retention-time reports

@query
def replicate_means(spark, sf):
    means = average(tidy_view(spark, sf))
    return plain(means.select(
        *EXPERIMENT_OUT, "peptide", "fragment_ion", "heavy_transition_rank", "run", "texlevel", *AVERAGED
    ))


@query
def replicate_cv(spark, sf):
    spread = vary(tidy_view(spark, sf), as_percent=False)
    return plain(spread.select(*EXPERIMENT_OUT, "peptide_mods", "fragment_ion", *AVERAGED))


@query
def replicate_cv_percent(spark, sf):
    spread = vary(tidy_view(spark, sf))
    return spread.select("subject_id", "condition", "peptide_mods", "fragment_ion", *AVERAGED)


@query
def peptide_concentrations(spark, sf):
    found = concentrate(average(tidy_view(spark, sf)), V.peptide_info(spark, sf), na_rm_relative=True)
    return plain(found.select(
        "set", "run", "peptide", "protein", "stage_specificity", *EXPERIMENT_OUT, "histology", "tese", "texlevel",
        "rdotp", "concentration_fm_ul", "concentration_ug_ml", "lth", "heavy_background", "light_background",
        "heavy_max_height", "light_max_height", "fmol_ul", "loq_ug_ml", "lod", "lh_rt_diff", "heavy_snr", "light_snr",
        "molecular_weight", "lh_rt_diff_rel",
    ))


@query
def rt_report(spark, sf):
    """Strict report beside the one that leaves NULLs out."""
    tidy = tidy_view(spark, sf)
    both = report_times(tidy, ordered=False).withColumn("missing", F.lit("strict")).unionByName(
        report_times(tidy, na_rm=True, ordered=False).withColumn("missing", F.lit("left out"))
    )
    return plain(both)


@query
def rt_report_narm(spark, sf):
    return plain(report_times(tidy_view(spark, sf), na_rm=True, as_percent=False))


@query
def relative_to_max(spark, sf):
    items = V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.nullif("l_tax", F.lit(0.02)).alias("shift"), "l_quantity"
    )
    strict = relate(items, "shift", "shift_rel")
    return plain(relate(relate(strict, "shift", "shift_rel_na_rm", na_rm=True), "l_quantity", "quantity_rel"))


@query
def sort_by_concentration(spark, sf):
    return plain(sort_concentration(
        concentration_view(spark, sf).select("peptide", "subject_id", "condition", "concentration_ug_ml")
    ))


# Calibration

def replicate_view(spark, sf):
    return C.curve_replicates(V.curve_measurements(spark, sf), V.peptide_info(spark, sf))


def point_view(spark, sf):
    return C.curve_points(replicate_view(spark, sf), V.peptide_info(spark, sf), max_cv=MAX_CV)


def range_view(spark, sf):
    return C.linear_range(point_view(spark, sf), V.peptide_amounts(spark, sf))


@query
def curve_replicates(spark, sf):
    return plain(replicate_view(spark, sf))


@query
def curve_points(spark, sf):
    return plain(point_view(spark, sf))


@query
def linear_range(spark, sf):
    return plain(range_view(spark, sf))


@query
def limit_of_quantification(spark, sf):
    return plain(C.limit_of_quantification(range_view(spark, sf), V.peptide_info(spark, sf)))


@query
def calibration_fit(spark, sf):
    return plain(C.calibration_fit(range_view(spark, sf)))


@query
def calibration_fit_log(spark, sf):
    return plain(C.calibration_fit(range_view(spark, sf), log=True))


@query
def tidy_calibration(spark, sf):
    """Six measures pivoted, ratios of 0 replaced by the area ratio, pasted ids."""
    report = V.assay_long(spark, sf).withColumn("lth", F.when(F.col("fragment_ion") == "R", 0.0).otherwise(F.col("lth")))
    wide = C.with_calibration_ids(C.tidify_calibration(report))
    measures = [f"{i}_{m}" for i in ISOTOPES for m in C.CURVE_MEASURES]
    return plain(wide.select(
        "transition_id", "experiment_id", "experiment_transition_id", "protein", "fmol_ug", "fmol_ul", "rdotp", "lth", *measures
    ))


@query
def optimal_spike(spark, sf):
    return plain(C.optimal_spike(tidy_view(spark, sf)))


@query
def curve_transition_summary(spark, sf):
    tidy = tidy_view(spark, sf).withColumn("lth", F.when(F.col("fragment_ion") == "R", 0.0).otherwise(F.col("lth")))
    return plain(C.curve_transition_summary(tidy), nudge=1e-9)


@query
def curve_frame(spark, sf):
    return plain(P.curve_frame(range_view(spark, sf)))


# Longitudinal

def longitudinal_view(spark, sf):
    return W.longitudinal(
        V.followed_subjects(spark, sf), "subject_id", BRAND, "timepoint", ["-concentration_ug_ml"], study=V.peptide_info(spark, sf)
    )


@query
def ratio_to_group_min(spark, sf):
    return plain(W.ratio_to_group_min(V.followed_subjects(spark, sf), ["subject_id", "peptide"]))


def deviation_view(spark, sf):
    return W.subject_deviations(
        V.followed_subjects(spark, sf), "subject_id", BRAND, "timepoint", ["-concentration_ug_ml"], study=V.peptide_info(spark, sf)
    )


@query
def sd_ratio(spark, sf):
    return plain(deviation_view(spark, sf))


@query
def mean_sd_ratio(spark, sf):
    return plain(W.mean_sd_ratio(deviation_view(spark, sf), BRAND))


@query
def timepoint_frame(spark, sf):
    return plain(P.timepoint_frame(longitudinal_view(spark, sf), "subject_id", BRAND, "timepoint"))


@query
def rank_avg(spark, sf):
    items = V.table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_quantity")
    return plain(rank_values(items, ["l_returnflag"], "l_quantity"))


@query
def rank_sum(spark, sf):
    sums = V.customer_items(spark, sf).groupBy("c_nationkey", "p_brand").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("amount")
    )
    return plain(sum_ranks(rank_values(sums, ["p_brand"], "amount"), ["c_nationkey"], "p_brand"))


# Group tests

@query
def group_counts(spark, sf):
    return V.group_values(spark, sf).groupBy("peptide", "segment").agg(F.count(F.lit(1)).alias("n"))


@query
def anova_oneway(spark, sf):
    return plain(T.anova_oneway(V.group_values(spark, sf), BRAND, "segment", "value"), ms_error=3)


@query
def tukey_hsd(spark, sf):
    return plain(T.tukey_hsd(V.group_values(spark, sf), BRAND, "status", "value"), p=4, lower=3, upper=3)


@query
def duncan_mrt(spark, sf):
    return plain(T.duncan_mrt(V.group_values(spark, sf), BRAND, "segment", "value"))


@query
def anova_posthoc(spark, sf):
    found = T.anova_posthoc(V.group_values(spark, sf), BRAND, "status", "value", ALPHA)
    parts = [
        found["anova"].select("peptide", F.lit("anova").alias("test"), F.col("f").alias("statistic"), "p"),
        *[found[test].select("peptide", F.lit(test).alias("test"), "group1", "group2", F.col("q").alias("statistic"), "p")
          for test in ("tukey", "duncan")],
    ]
    return plain(R.union_sets(*parts), p=4)


@query
def kruskal_wallis(spark, sf):
    return plain(T.kruskal_wallis(V.group_values(spark, sf), BRAND, "segment", "l_quantity"))


@query
def dunn_test(spark, sf):
    return plain(T.dunn_test(V.group_values(spark, sf), BRAND, "status", "l_quantity"))


@query
def kruskal_dunn(spark, sf):
    found = T.kruskal_dunn(V.group_values(spark, sf), BRAND, "segment", "l_quantity", ALPHA)
    parts = [
        found["kruskal"].select("peptide", F.lit("kruskal").alias("test"), F.col("h").alias("statistic"), "p"),
        found["dunn"].select("peptide", F.lit("dunn").alias("test"), "group1", "group2", F.col("z").alias("statistic"),
                             F.col("p_adjusted").alias("p")),
    ]
    return plain(R.union_sets(*parts))


@query
def group_tests_by_factor(spark, sf):
    rows = V.group_values(spark, sf)
    return plain(T.group_tests_by_factor(rows, BRAND, ["segment", "status", "priority"], "value", ALPHA), p=4)


@query
def p_adjust_bh(spark, sf):
    parts = V.table(spark, sf, "part").select("p_partkey", "p_brand", (F.col("p_size") / 60.0).alias("p"))
    by_brand = T.p_adjust_bh(parts, "p", ["p_brand"], out="p_brand_bh")
    return plain(T.p_adjust_bh(by_brand, "p", out="p_bh"))


# Paired tests

def wide_view(spark, sf, subject="c_nationkey"):
    return B.paired_wide(
        V.before_after(spark, sf, subject), "subject_id", BRAND, "condition", "l_extendedprice", on_duplicate="mean"
    )


def biomarker_view(spark, sf):
    return B.paired_biomarkers(wide_view(spark, sf), BRAND, SMALL_FOLD, ALPHA)


@query
def paired_wide(spark, sf):
    return plain(B.paired_described(wide_view(spark, sf, "o_custkey"), V.peptide_info(spark, sf)))


@query
def paired_summary(spark, sf):
    return plain(B.paired_summary(wide_view(spark, sf), BRAND))


@query
def paired_t(spark, sf):
    return plain(B.paired_t(wide_view(spark, sf), BRAND))


@query
def wilcoxon_signed_rank(spark, sf):
    return plain(B.wilcoxon_signed_rank(wide_view(spark, sf), BRAND))


@query
def wilcoxon_normal(spark, sf):
    return plain(B.wilcoxon_signed_rank(wide_view(spark, sf, "o_custkey"), BRAND))


@query
def paired_biomarker_table(spark, sf):
    table = B.paired_described(biomarker_view(spark, sf), V.peptide_info(spark, sf))
    return plain(table.drop("n_at_power", "pairs_needed"), power=4)


@query
def paired_sample_size(spark, sf):
    """Smallest number of pairs with a power of 0.8, and the power with these and with one less."""
    from assayspark.functions.tails import paired_t_power

    def power(n):
        return paired_t_power(n.cast("double"), F.col("cohen_d"), F.lit(0.05))

    needed = F.col("pairs_needed")
    return plain(biomarker_view(spark, sf).select(
        "peptide", "cohen_d", "pairs_needed", power(needed).alias("power_reached"),
        power(F.when(needed > 2, needed - 1)).alias("power_below"),
    ), power_reached=5, power_below=5)


@query
def volcano_flags(spark, sf):
    return biomarker_view(spark, sf).select("peptide", "flag_t", "flag_bh", "flag_u_bh")


@query
def volcano_frame(spark, sf):
    return plain(P.volcano_frame(biomarker_view(spark, sf), BRAND))


# Correlation

def correlation_view(spark, sf):
    sums = V.line_items(spark, sf).groupBy("l_suppkey", F.year("o_orderdate").alias("year"), "p_brand").agg(
        F.sum("l_extendedprice").alias("amount")
    )
    return correlate(sums, ["l_suppkey", "year"], "p_brand", "amount")


@query
def cross_correlation(spark, sf):
    return plain(correlation_view(spark, sf))


@query
def correlation_frame(spark, sf):
    return plain(P.correlation_frame(correlation_view(spark, sf)))


# Classifiers

@query
def logistic_fit(spark, sf):
    return plain(L.logistic_fit(V.labelled_documents(spark, sf), LANGUAGE, "x", "y", tol=TOLERANCE).drop("iterations"))


@query
def score(spark, sf):
    rows = V.labelled_documents(spark, sf)
    fits = L.logistic_fit(rows, LANGUAGE, "x", "y", tol=TOLERANCE)
    return plain(L.score(rows, fits, LANGUAGE, "x"))


@query
def confusion_metrics(spark, sf):
    rows = V.labelled_documents(spark, sf)
    fits = L.logistic_fit(rows, LANGUAGE, "x", "y", tol=TOLERANCE)
    return plain(L.confusion_metrics(L.score(rows, fits, LANGUAGE, "x"), LANGUAGE, "y"))


@query
def roc_curve(spark, sf):
    return plain(L.roc_curve(V.marker_rows(spark, sf), BRAND, "x", "y"), binary=True)


@query
def auc(spark, sf):
    return plain(L.auc(V.marker_rows(spark, sf), BRAND, "x", "y", digits=None))


@query
def classifier_table(spark, sf):
    return plain(L.classifier_table(V.labelled_documents(spark, sf), LANGUAGE, "x", "y"), cutoff=4)


@query
def classifier_on_train(spark, sf):
    return plain(L.classifier_table(
        V.labelled_documents(spark, sf), LANGUAGE, "x", "y", fit_on="train", row_key=["doc_id"]
    ), cutoff=4)


@query
def marker_subset(spark, sf):
    """Language family recoded, one language left out, then one classifier per family."""
    rows = keep_conditions(V.labelled_documents(spark, sf), "lang", drop=["de"])
    recoded = rows.withColumn("lang", X.recode(F.col("lang"), {"fr": "romance", "es": "romance"}))
    return plain(L.classifier_table(recoded, LANGUAGE, "x", "y"), cutoff=4)


@query
def merge_performance(spark, sf):
    classifiers = L.classifier_table(V.marker_rows(spark, sf), BRAND, "x", "y")
    merged = L.merge_performance(biomarker_view(spark, sf), classifiers, BRAND)
    return plain(merged.select("peptide", "mean_fc", "accuracy", "sensitivity", "specificity", "auc"))


@query
def marker_score(spark, sf):
    classifiers = L.classifier_table(V.marker_rows(spark, sf), BRAND, "x", "y")
    merged = L.merge_performance(biomarker_view(spark, sf), classifiers, BRAND)
    return plain(L.marker_score(merged).select("peptide", "mean_fc", "power", "accuracy", "auc", "score"), power=4, score=4)


@query
def logistic_frame(spark, sf):
    rows = V.labelled_documents(spark, sf)
    fits = L.logistic_fit(rows, LANGUAGE, "x", "y", tol=TOLERANCE)
    return plain(P.logistic_frame(rows, fits, LANGUAGE, "x", "y"), cutoff=4)


# Plot frames

@query
def lod_frame(spark, sf):
    return plain(P.lod_frame(concentration_view(spark, sf)))


@query
def lod_override(spark, sf):
    return plain(P.lod_override(concentration_view(spark, sf), run=2, rule=3, max_shift=0.123))


@query
def strip_summary(spark, sf):
    return plain(P.strip_summary(V.group_values(spark, sf), BRAND, "priority", "value"))


@query
def strip_outliers(spark, sf):
    return plain(P.strip_outliers(V.group_values(spark, sf), BRAND, "priority", "value"))


@query
def strip_summary_lod(spark, sf):
    """Boxes with the detection limit of their analyte."""
    rows = join_dimension(V.group_values(spark, sf), V.peptide_amounts(spark, sf), "peptide", ["lod"])
    return plain(P.strip_summary(rows, BRAND, "segment", "value", lod="lod"))


@query
def volcano_plot(spark, sf):
    table = B.paired_described(biomarker_view(spark, sf), V.peptide_info(spark, sf))
    return plain(P.volcano_plot(table, BRAND, "protein", low=-1.0, high=1.0, steps=40, fc=SMALL_FOLD, alpha=ALPHA))


@query
def logistic_plot(spark, sf):
    rows = V.labelled_documents(spark, sf)
    fits = L.logistic_fit(rows, LANGUAGE, "x", "y", tol=TOLERANCE)
    return plain(P.logistic_plot(rows, fits, LANGUAGE, "x", "y"), cutoff=4)


@query
def density_histogram(spark, sf):
    return plain(P.density_histogram(V.table(spark, sf, "events"), "value", 5.0))


@query
def qq_frame(spark, sf):
    return plain(P.qq_frame(V.table(spark, sf, "events"), "value", ["event_type"]), theoretical=4)


@query
def strict_mean(spark, sf):
    items = V.table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return plain(items.groupBy("l_orderkey").agg(
        mean("l_tax").alias("mean_tax"), mean("l_tax", na_rm=True).alias("mean_tax_na_rm")
    ))
