"""Hand-made rows, one group per semantic trap."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assayspark.functions import aggregates as A
from assayspark.functions import expressions as X
from assayspark.operators import calibration, classify, frames, groups, longitudinal, paired, ranks, reshape
from assayspark.operators.correlation import cross_correlation
from assayspark.operators.filters import complete_subjects, drop_unknown
from assayspark.operators.joins import drop_botched, enrich_left, lookup_first
from assayspark.operators.replicates import relative_to_max, sort_concentration, with_run_and_trial


def values(df, column):
    return [r[column] for r in df.collect()]


def test_run_trial_and_curve_point(spark):
    names = spark.createDataFrame([("12_S1_rep2",), ("x_rep",), ("rep3",)], "replicate_name string")
    found = with_run_and_trial(names).collect()
    assert [(r.run, r.trial) for r in found] == [(12, 2), (None, None), (None, 3)]
    points = spark.createDataFrame([("a_P0_5-1",), ("a_P10-1",), ("a_P1__5-1",), ("a",)], "n string")
    assert values(points.select(X.extract_curve_point("n").alias("p")), "p") == [0.5, 10.0, None, None]


def test_label_reads_missing_as_text(spark):
    row = spark.createDataFrame([(None, "A", 1.0)], "a string, b string, c double")
    assert values(row.select(X.joined_label("a", "b", "c").alias("x")), "x") == ["NA_A_1"]


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(0.00125,), (0.125,), (None,)], "x double")
    assert values(df.select(X.percent(F.col("x")).alias("p")), "p") == ["0.13%", "12.50%", None]


def test_fill_defaults(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0, None, 1.0, 1.0, 1, 1.0), (None, None, 2.0, None, None, None, None), (1.0, 5.0, 0.0, 1.0, 1.0, 1, 1.0)],
        "area double, background double, lth double, rdotp double, max_height double, transition_rank int, retention_time double",
    )
    found = X.fill_defaults(df)
    assert values(found, "background") == [1.0, 1.0, 5.0]
    assert values(found, "area") == [1.0, 0.0, 1.0] and values(found, "lth") == [0.0, 2.0, 0.0]


def test_ratio_fallback(spark):
    df = spark.createDataFrame([(0.0, 2.0, 4.0), (None, 1.0, 1.0), (3.0, 1.0, 1.0), (0.0, 1.0, 0.0)],
                               "lth double, light_area double, heavy_area double")
    assert values(calibration.ratio_fallback(df), "lth") == [0.5, None, 3.0, None]


def test_threshold_pole_and_sides(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (-2.0,)], "x double")
    plain = values(df.select(X.hyperbolic_threshold(F.col("x")).alias("t")), "t")
    level = -math.log10(0.05)
    assert plain[0] == math.inf and plain[1:] == pytest.approx([0.5 + level, 0.5 / 3 + level])
    even = values(df.select(X.hyperbolic_threshold(F.col("x"), symmetric=True).alias("t")), "t")
    assert even[1] == pytest.approx(even[2])


def test_strict_and_lenient_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "k string, x double")
    found = {r.k: (r.s, r.l, r.v) for r in df.groupBy("k").agg(
        A.mean("x").alias("s"), A.mean("x", True).alias("l"), A.cv("x", True).alias("v")).collect()}
    assert found == {"a": (None, 1.0, None), "b": (2.0, 2.0, None)}


def test_botched_runs_keep_unknown_run(spark):
    rows = spark.createDataFrame([("s", 1), ("s", 2), ("s", None), ("t", 2)], "set string, run bigint")
    botched = spark.createDataFrame([("s", 2)], "set string, run bigint")
    left = {(r["set"], r["run"]) for r in drop_botched(rows, botched).collect()}
    assert left == {("s", 1), ("s", None), ("t", 2)}


def test_unknown_group_and_sort(spark):
    rows = spark.createDataFrame([("a",), ("unknown",), (None,)], "g string")
    assert values(drop_unknown(rows, "g"), "g") == ["a"]
    amounts = spark.createDataFrame([("p", 3.0), ("p", None), ("p", 7.0), (None, 1.0)], "peptide string, concentration_ug_ml double")
    assert values(sort_concentration(amounts), "concentration_ug_ml") == [7.0, 3.0, None, 1.0]


def test_relative_to_max_strictness(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert sorted(values(relative_to_max(rows, "x", "r"), "r"), key=str) == [1.0, None, None]
    assert sorted(values(relative_to_max(rows, "x", "r", na_rm=True), "r")) == [0.5, 1.0, 1.0]


def test_dimension_joins(spark):
    rows = spark.createDataFrame([("a",), (None,), ("z",)], "peptide string")
    dimension = spark.createDataFrame([("a", 1.0), (None, 2.0)], "peptide string, mw double")
    assert sorted(values(enrich_left(rows, dimension, "peptide"), "mw"), key=str) == [1.0, 2.0, None]
    repeated = dimension.union(spark.createDataFrame([("a", 0.5)], "peptide string, mw double"))
    joined = enrich_left(rows, repeated, "peptide")
    with pytest.raises(PySparkException, match="repeats"):
        joined.collect()
    first = lookup_first(rows, repeated, "peptide", ["mw"], ["mw"])
    assert sorted(values(first, "mw"), key=str) == [0.5, 2.0, None]


def test_first_row_is_stable_under_shuffling(spark):
    rows = spark.createDataFrame([("k", i, f"v{i}") for i in range(50)], "k string, row_id int, v string")
    for partitions in (1, 3, 7):
        assert values(reshape.distinct_first(rows.repartition(partitions), ["k"], ["row_id"]), "v") == ["v0"]


def test_pivot_duplicates_and_missing(spark):
    rows = spark.createDataFrame([(1, "heavy", 2.0), (1, "light", 3.0), (2, "heavy", 4.0)], "id int, isotope string, area double")
    wide = {r.id: (r.heavy_area, r.light_area) for r in reshape.pivot_multi(
        rows, ["id"], "isotope", ["area"], ["heavy", "light"]).collect()}
    assert wide == {1: (2.0, 3.0), 2: (4.0, None)}
    twice = rows.union(spark.createDataFrame([(1, "heavy", 6.0)], "id int, isotope string, area double"))
    with pytest.raises(Exception, match="more than one row per id"):
        reshape.pivot_multi(twice, ["id"], "isotope", ["area"], ["heavy", "light"]).collect()
    mean = reshape.pivot_multi(twice, ["id"], "isotope", ["area"], ["heavy"], on_duplicate="mean", camel=True)
    assert {r.id: r.heavyArea for r in mean.collect()} == {1: 4.0, 2: 4.0}
    first = reshape.pivot_multi(
        twice, ["id"], "isotope", ["area"], ["heavy"], order_by=["area"], on_duplicate="first", rename=False
    )
    assert {r.id: r.heavy for r in first.collect()} == {1: 2.0, 2: 4.0}


def curve(spark, flags, linlim=2.0):
    rows = [(float(i + 1), "p", 1.0, 0.1, 0.1, float(i + 1), f, "P", "s") for i, f in enumerate(flags)]
    points = spark.createDataFrame(
        rows, "curvepoint double, peptide string, mean_htl double, sd_htl double, cv_htl double, theor_h_ug_ml double, "
        "sdthr boolean, protein string, stage_specificity string")
    amounts = spark.createDataFrame([("p", linlim)], "peptide string, linlim double")
    return calibration.linear_range(points, amounts).orderBy("curvepoint")


def test_linear_range_and_limit(spark):
    ranged = curve(spark, [False, True, False, True, True])
    assert values(ranged, "cthr") == [False, False, False, True, True]
    info = spark.createDataFrame([("p", "P", "s")], "peptide string, protein string, stage_specificity string")
    assert values(calibration.limit_of_quantification(ranged, info), "loq_point") == [4.0]
    unknown = curve(spark, [True, None, True])
    assert values(unknown, "sdthr") == [None, None, None]


def test_line_fit_without_variation(spark):
    flat = spark.createDataFrame([("p", 1.0, 2.0), ("p", 1.0, 3.0)], "k string, x double, y double")
    row = calibration.line_fit(flat, ["k"], "x", "y").first()
    assert row.slope is None and row.r2 is None


def group_rows(spark, *parts):
    return spark.createDataFrame([("p", f"g{i}", float(v)) for i, part in enumerate(parts) for v in part],
                                 "peptide string, g string, v double")


def test_anova_reference_values(spark):
    row = groups.anova_oneway(group_rows(spark, (1, 2, 3), (2, 3, 4), (5, 6, 7)), ["peptide"], "g", "v").first()
    assert (row.f, row.df1, row.df2) == (pytest.approx(13.0), 2, 6) and row.p == pytest.approx((6 / 32) ** 3)
    single = groups.anova_oneway(group_rows(spark, (1, 2, 3)), ["peptide"], "g", "v").first()
    assert single.f is None and single.p is None


def test_tukey_interval(spark):
    rows = group_rows(spark, (1, 2, 3), (2, 3, 4), (5, 6, 7))
    pair = groups.tukey_hsd(rows, ["peptide"], "g", "v").filter("group1 = 'g0' and group2 = 'g2'").first()
    half = 4.339 * math.sqrt(1 / 3)
    assert (pair["diff"], pair.lower, pair.upper) == pytest.approx((4.0, 4 - half, 4 + half), abs=2e-3)


def test_duncan_adjacent_pair_is_t_test(spark):
    from assayspark.functions.tails import t_sf
    import numpy as np

    rows = group_rows(spark, (1, 2, 3), (2, 3, 4), (5, 6, 7))
    pair = groups.duncan_mrt(rows, ["peptide"], "g", "v", digits=None).filter("group1 = 'g0' and group2 = 'g1'").first()
    t = 1 / math.sqrt(2 / 3)
    assert pair.span == 2 and pair.p == pytest.approx(2 * t_sf(np.array([t]), np.array([6.0]))[0], rel=1e-6)


def test_kruskal_reference_values(spark):
    row = groups.kruskal_wallis(group_rows(spark, (1, 2, 3), (4, 5, 6)), ["peptide"], "g", "v").first()
    assert row.h == pytest.approx(3.857143, abs=1e-6) and row.df == 1 and row.p == pytest.approx(0.0495346, abs=1e-6)
    flat = groups.kruskal_wallis(group_rows(spark, (1, 1), (1, 1)), ["peptide"], "g", "v").first()
    assert flat.h is None and flat.p is None


def test_two_peptides_of_one_protein_stay_apart(spark):
    rows = spark.createDataFrame([("P", pep, g, float(v)) for pep in ("a", "b") for g, v in (("x", 1), ("x", 2), ("y", 4), ("y", 6))],
                                 "protein string, peptide string, g string, v double")
    assert groups.anova_oneway(rows, ["protein", "peptide"], "g", "v").count() == 2


def test_benjamini_hochberg(spark):
    rows = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.005,), (None,)], "p double")
    found = {r.p: r.adj for r in groups.p_adjust_bh(rows, "p", out="adj").collect()}
    assert found[0.01] == found[0.005] == pytest.approx(0.02) and found[0.04] == found[0.03] == pytest.approx(0.04)
    assert found[None] is None


def wide(spark, pre, post):
    return spark.createDataFrame([(i, "p", a, b, (a / b if b else None)) for i, (a, b) in enumerate(zip(pre, post))],
                                 "subject int, peptide string, pre double, post double, fc double")


def test_paired_t_and_signed_rank(spark):
    row = paired.paired_t(wide(spark, [5.0, 7.0, 9.0], [4.0, 5.0, 6.0]), ["peptide"]).first()
    assert row.t == pytest.approx(3.4641016) and row.df == 2 and row.p == pytest.approx(0.0370900, abs=1e-6)
    ranked = paired.wilcoxon_signed_rank(wide(spark, [2.0, 4.0, 1.0, 9.0], [1.0, 2.0, 4.0, 5.0]), ["peptide"]).first()
    assert ranked.v == 7.0 and ranked.exact and ranked.p == pytest.approx(0.625)
    zero = paired.wilcoxon_signed_rank(wide(spark, [2.0, 4.0, 3.0], [1.0, 2.0, 3.0]), ["peptide"]).first()
    assert zero.zeros == 1 and zero.n == 2 and not zero.exact


def test_average_rank_descending(spark):
    rows = spark.createDataFrame([("p", 10.0), ("p", 20.0), ("p", 20.0), ("p", 30.0), ("p", None)], "protein string, v double")
    found = sorted(((r.v, r.rank) for r in ranks.rank_avg(rows, ["protein"], "v").collect()), key=str)
    assert found == [(10.0, 4.0), (20.0, 2.5), (20.0, 2.5), (30.0, 1.0), (None, None)]


def test_rank_sum_missing_analyte(spark):
    rows = spark.createDataFrame([("s1", "a", 1.0), ("s1", "b", 2.0), ("s2", "a", 2.0), ("s2", "b", 1.0), ("s3", "a", 3.0)],
                                 "sample string, protein string, rank double")
    found = {r["sample"]: (r.rank_sum, r.place) for r in ranks.rank_sum(rows, ["sample"], "protein").collect()}
    assert found == {"s1": (3.0, 1), "s2": (3.0, 1), "s3": (None, None)}


def test_auc_and_roc(spark):
    rows = spark.createDataFrame([("p", s, y) for s, y in ((0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0))],
                                 "peptide string, s double, y int")
    assert classify.auc(rows, ["peptide"], "s", "y").first().auc == 0.75
    curve_rows = classify.roc_curve(rows, ["peptide"], "s", "y").orderBy(F.desc("cutoff")).collect()
    assert (curve_rows[0].fpr, curve_rows[0].tpr, curve_rows[0].cutoff) == (0.0, 0.0, math.inf)
    assert [(r.fpr, r.tpr) for r in curve_rows[1:]] == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_separated_classes_and_flat_label(spark):
    rows = spark.createDataFrame(
        [("sep", float(x), int(x > 2)) for x in (1, 2, 3, 4)] + [("flat", 1.0, 1), ("flat", 2.0, 1)]
        + [("mixed", float(x), y) for x, y in ((1, 0), (2, 1), (3, 0), (4, 1))], "peptide string, x double, y int")
    fits = {r.peptide: r for r in classify.logistic_fit(rows, ["peptide"], "x", "y").collect()}
    assert fits["sep"].separated and fits["sep"].cutoff == pytest.approx(2.5, abs=0.05)
    assert fits["flat"].slope is None
    assert not fits["mixed"].separated and fits["mixed"].converged
    b0, b1 = fits["mixed"].intercept, fits["mixed"].slope
    fitted = [1 / (1 + math.exp(-(b0 + b1 * x))) for x in (1, 2, 3, 4)]
    assert sum(fitted) == pytest.approx(2.0, abs=1e-6)
    assert sum(f * x for f, x in zip(fitted, (1, 2, 3, 4))) == pytest.approx(6.0, abs=1e-6)


def test_confusion_without_predicted_positives(spark):
    rows = spark.createDataFrame([("p", 0, 1), ("p", 0, 0)], "peptide string, predicted int, y int")
    row = classify.confusion_metrics(rows, ["peptide"], "y").first()
    assert (row.tp, row.sensitivity, row.specificity, row.accuracy) == (0, 0.0, 1.0, 0.5)


def test_longitudinal_joins_on_subject_and_peptide(spark):
    rows = spark.createDataFrame(
        [("s", pep, t, float(v)) for pep, t, v in (("a", 1, 2), ("a", 2, 4), ("b", 1, 0), ("b", 2, 3))] + [("once", "a", 1, 5.0)],
        "subject_id string, peptide string, timepoint int, concentration_ug_ml double")
    found = longitudinal.longitudinal(rows, "subject_id", ["peptide"], "timepoint", ["concentration_ug_ml"])
    assert found.count() == 4
    assert {(r.peptide, r.timepoint): r.concentration_r for r in found.collect()} == {
        ("a", 1): 1.0, ("a", 2): 2.0, ("b", 1): 1.0, ("b", 2): 3.0}
    assert complete_subjects(rows, "subject_id", ["peptide"]).select("subject_id").distinct().count() == 1


def test_correlation_null_for_constant(spark):
    cells = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (1, "c", 5.0), (2, "c", 5.0)], "r int, item string, v double")
    found = {(r.item, r.combination): r.correlation for r in cross_correlation(cells, ["r"], "item", "v").collect()}
    assert found == {("a", "a"): pytest.approx(1.0), ("a", "c"): None, ("c", "a"): None, ("c", "c"): None}
    with pytest.raises(Exception, match="more than one"):
        cross_correlation(cells.union(cells), ["r"], "item", "v").collect()


def test_strip_uses_log_scale_without_zeros(spark):
    rows = spark.createDataFrame([("p", "g", 0.0), ("p", "g", 1.0), ("p", "g", 100.0), ("p", "unknown", 9.0)],
                                 "peptide string, g string, v double")
    row = frames.strip_summary(rows, ["peptide"], "g", "v").first()
    assert (row.n, row.geometric_mean, row.median) == (2, pytest.approx(10.0), 1.0)


def test_qq_positions(spark):
    rows = spark.createDataFrame([(float(v),) for v in (3, 1, 2)], "v double")
    found = frames.qq_frame(rows, "v").orderBy("place").collect()
    assert [r.value for r in found] == [1.0, 2.0, 3.0]
    assert [r.p for r in found] == pytest.approx([(i - 0.375) / 3.25 for i in (1, 2, 3)])
    assert found[1].theoretical == pytest.approx(0.0, abs=1e-9) and found[2].theoretical == pytest.approx(0.8694238, abs=1e-6)


def test_recode_and_firstcap(spark):
    rows = spark.createDataFrame([("POSTvas",), ("NOA",), (None,)], "c string")
    assert values(rows.select(X.recode(F.col("c"), {"POSTvas": "OA"}).alias("x")), "x") == ["OA", "NOA", None]
    assert values(rows.select(X.binary_class(F.col("c"), "NOA").alias("x")), "x") == [0, 1, None]
    words = spark.createDataFrame([("aBC def",), ("",)], "c string")
    assert values(words.select(X.firstcap("c").alias("x")), "x") == ["ABC def", ""]


def test_first_row_keeps_attributes_whose_order_is_null(spark):
    from assayspark.operators.joins import lookup_first

    info = spark.createDataFrame([("A", "p2", 1.0), ("A", "p1", 2.0), ("B", None, 200.0)], "peptide string, protein string, mw double")
    rows = spark.createDataFrame([("A",), ("B",), ("C",)], "peptide string")
    found = {r.peptide: (r.protein, r.mw) for r in lookup_first(rows, info, "peptide", ["protein", "mw"], ["protein"]).collect()}
    assert found == {"A": ("p1", 2.0), "B": (None, 200.0), "C": (None, None)}


def test_longitudinal_keeps_the_highest_concentration(spark):
    rows = spark.createDataFrame(
        [("s", "p", 1, "NOA", 5.0), ("s", "p", 1, "OA", 9.0), ("s", "p", 2, "NOA", 3.0), ("s", "p", 2, "OA", None)],
        "subject_id string, peptide string, timepoint int, condition string, concentration_ug_ml double",
    )
    found = longitudinal.longitudinal(rows, "subject_id", ["peptide"], "timepoint", ["-concentration_ug_ml", "condition"])
    assert {r.timepoint: r.concentration_ug_ml for r in found.collect()} == {1: 9.0, 2: 3.0}


def test_shares_are_rounded_as_in_sql(spark):
    """41/640 ends in a 5 at the seventh place as a text, but its double times a million lies below the half."""
    import duckdb

    from assayspark.plans.queries import plain

    shares = [(k / 640,) for k in range(640)] + [(float("inf"),)]
    found = plain(spark.createDataFrame(shares, "share double"), binary=True).collect()
    expected = duckdb.connect().execute("SELECT round(s, 6) FROM (SELECT unnest(?::DOUBLE[]) AS s)", [[s for s, in shares]]).fetchall()
    assert sorted(r.share for r in found) == sorted(v for v, in expected)
