"""Group comparison per analyte: ANOVA with Tukey and Duncan, Kruskal-Wallis with Dunn.

Measurements are reduced to one row per analyte and group first; tests and pairs work on that
summary, all analytes at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayspark.functions.aggregates import centred_sum_of_squares
from assayspark.functions.tails import chi2_tail, f_tail, normal_tail, tukey_quantile, tukey_tail
from assayspark.operators.filters import drop_unknown, significant
from assayspark.operators.scale import (
    SLICE, attach, cut_lineage, in_slices, null_safe_join, placed_rows, running, session_partitions,
)


def _complete(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    present = F.col(group).isNotNull() & F.col(value).isNotNull()
    return df.filter(present).select(*analyte, F.col(group).alias("group"), F.col(value).cast("double").alias("value"))


def group_summary(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    """Count, mean and centred sum of squares per analyte and group, materialised."""
    return cut_lineage(
        _complete(df, analyte, group, value).groupBy(*analyte, "group").agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
            centred_sum_of_squares("value").alias("ss"),
        )
    )


def _anova(summary: DataFrame, analyte: list[str]) -> DataFrame:
    levels = Window.partitionBy(*analyte)
    grand = F.sum(F.col("n") * F.col("mean")).over(levels) / F.sum("n").over(levels)
    parts = summary.withColumn("_between", F.col("n") * F.pow(F.col("mean") - grand, F.lit(2.0)))
    totals = parts.groupBy(*analyte).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum("_between").alias("_ssb"), F.sum("ss").alias("_ssw"),
        (F.count(F.lit(1)) / F.sum(1.0 / F.col("n"))).alias("harmonic_n"),
    ).withColumns({"df1": F.col("k") - 1, "df2": F.col("n") - F.col("k")})
    table = totals.withColumn("ms_error", F.try_divide(F.col("_ssw"), F.col("df2").cast("double"))).withColumn(
        "f", F.try_divide(F.try_divide(F.col("_ssb"), F.col("df1").cast("double")), F.col("ms_error"))
    )
    return table.withColumn(
        "p", f_tail(F.col("f"), F.col("df1").cast("double"), F.col("df2").cast("double"))
    ).select(*analyte, "k", "n", "df1", "df2", "ms_error", "harmonic_n", "f", "p")


def anova_oneway(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    """F test of value by group per analyte; NULL for a single group or no residual variation."""
    return _anova(group_summary(df, analyte, group, value), analyte).drop("harmonic_n")


def _pairs(summary: DataFrame, analyte: list[str], columns: list[str]) -> DataFrame:
    """Group pairs of an analyte, the earlier level first, from the per-group summary."""
    first = summary.select(*analyte, F.col("group").alias("group1"), *[F.col(c).alias(f"{c}1") for c in columns])
    second = summary.select(*analyte, F.col("group").alias("group2"), *[F.col(c).alias(f"{c}2") for c in columns])
    return null_safe_join(first, second, analyte, "inner").filter(F.col("group1") < F.col("group2"))


def _tukey(summary: DataFrame, anova: DataFrame, analyte: list[str], level: float | None) -> DataFrame:
    columns = [*analyte, "k", "df2", "ms_error"]
    error = anova.select(*columns)
    if level is not None:
        error = error.withColumn(
            "_wide", tukey_quantile(F.lit(level), F.col("k").cast("double"), F.col("df2").cast("double"))
        )
    pairs = null_safe_join(_pairs(summary, analyte, ["n", "mean"]), error, analyte).withColumns({
        "diff": F.col("mean2") - F.col("mean1"),
        "_se": F.sqrt(F.col("ms_error") / 2 * (1.0 / F.col("n1") + 1.0 / F.col("n2"))),
    }).withColumn("q", F.try_divide(F.abs(F.col("diff")), F.col("_se")))
    out = pairs.withColumn(
        "p", tukey_tail(F.col("q"), F.col("k").cast("double"), F.col("df2").cast("double"))
    )
    if level is None:
        return out.select(*analyte, "group1", "group2", "diff", "q", "p")
    half = F.col("_wide") * F.col("_se")
    return out.select(
        *analyte, "group1", "group2", "diff", (F.col("diff") - half).alias("lower"),
        (F.col("diff") + half).alias("upper"), "q", "p",
    )


def tukey_hsd(
    df: DataFrame, analyte: list[str], group: str, value: str, level: float | None = 0.95
) -> DataFrame:
    """All group pairs: difference (later minus earlier level), interval and adjusted p."""
    summary = group_summary(df, analyte, group, value)
    return _tukey(summary, _anova(summary, analyte), analyte, level)


def _duncan(summary: DataFrame, anova: DataFrame, analyte: list[str], digits: int | None) -> DataFrame:
    by_mean = Window.partitionBy(*analyte).orderBy(F.desc("mean"), "group")
    placed = summary.withColumn("place", F.row_number().over(by_mean))
    pairs = null_safe_join(
        _pairs(placed, analyte, ["mean", "place"]), anova.select(*analyte, "df2", "ms_error", "harmonic_n"), analyte
    ).withColumns({
        "diff": F.col("mean2") - F.col("mean1"),
        "span": F.abs(F.col("place1") - F.col("place2")) + 1,
        "_se": F.sqrt(F.col("ms_error") / F.col("harmonic_n")),
    }).withColumn("q", F.try_divide(F.abs(F.col("diff")), F.col("_se")))
    tail = tukey_tail(F.col("q"), F.col("span").cast("double"), F.col("df2").cast("double"))
    tested = pairs.withColumn("_tail", tail).withColumn(
        "p", 1.0 - F.pow(1.0 - F.col("_tail"), 1.0 / (F.col("span") - 1))
    )
    if digits is not None:
        tested = tested.withColumn("p", F.round("p", digits))
    return tested.select(*analyte, "group1", "group2", "diff", F.col("span").cast("bigint").alias("span"), "q", "p")


def duncan_mrt(
    df: DataFrame, analyte: list[str], group: str, value: str, digits: int | None = 4
) -> DataFrame:
    """Duncan's multiple range test: the range spans the ordered means between the two groups."""
    summary = group_summary(df, analyte, group, value)
    return _duncan(summary, _anova(summary, analyte), analyte, digits)


def _tally(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    """Rows ``n`` per analyte, value and group."""
    return _complete(df, analyte, group, value).groupBy(*analyte, "value", "group").agg(F.count(F.lit(1)).alias("n"))


def _rank_summary(tallied: DataFrame, analyte: list[str]) -> DataFrame:
    """Count, rank sum and tie term per analyte and group, materialised.

    Equal values are tallied before ranks are made, and ranks come from slices of the value range.
    """
    counted = running(in_slices(tallied, analyte, ["value"]), analyte, ["value", "group"], sums={"upto": "n"})
    tied = Window.partitionBy(*analyte, SLICE, "value")
    ranked = counted.withColumns({"_tied": F.sum("n").over(tied), "_top": F.max("upto").over(tied)})
    rank = F.col("_top") - F.col("_tied") + (F.col("_tied") + 1) / 2
    tied_rows = F.col("_tied").cast("double")
    return cut_lineage(ranked.groupBy(*analyte, "group").agg(
        F.sum("n").alias("n"), F.sum(rank * F.col("n")).alias("rank_sum"),
        F.sum(F.col("n") * (tied_rows * tied_rows - 1)).alias("ties"),
    ))


def _moments(tallied: DataFrame, analyte: list[str]) -> DataFrame:
    """``group_summary`` from a written tally: means first, then squares about them."""
    keys = [*analyte, "group"]
    means = tallied.groupBy(*keys).agg(
        F.sum("n").alias("_rows"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean")
    )
    off = F.col("value") - F.col("mean")
    return cut_lineage(attach(tallied, means, keys, rows_per_key="_rows").groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("mean").alias("mean"), F.sum(F.col("n") * off * off).alias("ss"),
    ))


def _kruskal(ranks: DataFrame, analyte: list[str]) -> DataFrame:
    levels = Window.partitionBy(*analyte)
    total = F.sum("n").over(levels).cast("double")
    off_centre = F.col("n") * F.pow(F.col("rank_sum") / F.col("n") - (total + 1) / 2, F.lit(2.0))
    sums = ranks.withColumn("_off", off_centre).groupBy(*analyte).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ties").alias("ties"), F.sum("_off").alias("_off"),
    ).withColumn("_n", F.col("n").cast("double"))
    spread = F.try_divide(F.col("ties"), F.pow(F.col("_n"), F.lit(3.0)) - F.col("_n"))
    raw = F.try_divide(12 * F.col("_off"), F.col("_n") * (F.col("_n") + 1))
    tested = sums.withColumns({
        "df": F.col("k") - 1,
        "h": F.when(F.col("k") > 1, F.try_divide(raw, 1 - spread)),
    })
    return tested.withColumn("p", chi2_tail(F.col("h"), F.col("df").cast("double"))).select(
        *analyte, "k", "n", "df", "ties", "h", "p"
    )


def kruskal_wallis(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    """Tie-corrected H test per analyte; NULL where all values are equal."""
    return _kruskal(_rank_summary(_tally(df, analyte, group, value), analyte), analyte).drop("ties")


def p_adjust_bh(df: DataFrame, p: str, family: list[str] | None = None, out: str = "p_adjusted") -> DataFrame:
    """Benjamini-Hochberg adjustment over the rows of a family (all rows if none is named).

    The rows are adjusted where their slice of the p values is, whatever the size of a family or a tie. A NULL stays NULL.
    """
    family = family or []
    placed = placed_rows(df.filter(F.col(p).isNotNull()), family, p)
    raw = F.least(F.lit(1.0), F.col(p) * F.col("_all") / (F.col("_before") + F.col("_ties")))
    sliced = cut_lineage(placed.select(*df.columns, SLICE, raw.alias("_raw")))
    adjusted = running(sliced, family, [p], mins={out: "_raw"}, from_top=True).drop(SLICE, "_raw")
    return adjusted.unionByName(df.filter(F.col(p).isNull()).withColumn(out, F.lit(None).cast("double")))


def _dunn(ranks: DataFrame, analyte: list[str]) -> DataFrame:
    totals = ranks.groupBy(*analyte).agg(F.sum("n").cast("double").alias("_n"), F.sum("ties").alias("_ties"))
    pairs = null_safe_join(_pairs(ranks, analyte, ["n", "rank_sum"]), totals, analyte)
    variance = F.col("_n") * (F.col("_n") + 1) / 12 - F.try_divide(F.col("_ties"), 12 * (F.col("_n") - 1))
    spread = F.sqrt(variance * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    z = F.try_divide(F.col("rank_sum1") / F.col("n1") - F.col("rank_sum2") / F.col("n2"), spread)
    tested = pairs.withColumn("z", z).withColumn("p", normal_tail(F.abs(F.col("z"))))
    return p_adjust_bh(tested.select(*analyte, "group1", "group2", "z", "p"), "p", analyte).select(
        *analyte, "group1", "group2", "z", "p", "p_adjusted"
    )


def dunn_test(df: DataFrame, analyte: list[str], group: str, value: str) -> DataFrame:
    """Pairwise rank comparison with tie correction, one-sided p, adjusted within the analyte."""
    return _dunn(_rank_summary(_tally(df, analyte, group, value), analyte), analyte)


def anova_posthoc(
    df: DataFrame, analyte: list[str], group: str, value: str, alpha: float = 0.05
) -> dict[str, DataFrame]:
    """Analytes with ANOVA p below alpha, and their Tukey and Duncan pairs with p up to alpha."""
    return _posthoc(group_summary(df, analyte, group, value), analyte, alpha)


def _posthoc(summary: DataFrame, analyte: list[str], alpha: float) -> dict[str, DataFrame]:
    passed = cut_lineage(significant(_anova(summary, analyte), "p", alpha))
    concerned = null_safe_join(summary, passed.select(*analyte), analyte, "left_semi")
    return {
        "anova": passed.drop("harmonic_n"),
        "tukey": significant(_tukey(concerned, passed, analyte, None), "p", alpha, inclusive=True),
        "duncan": significant(_duncan(concerned, passed, analyte, 4), "p", alpha, inclusive=True),
    }


def kruskal_dunn(
    df: DataFrame, analyte: list[str], group: str, value: str, alpha: float = 0.05
) -> dict[str, DataFrame]:
    """Analytes with Kruskal-Wallis p below alpha, and their Dunn pairs with adjusted p up to alpha."""
    return _rank_posthoc(_rank_summary(_tally(df, analyte, group, value), analyte), analyte, alpha)


def _rank_posthoc(ranks: DataFrame, analyte: list[str], alpha: float) -> dict[str, DataFrame]:
    passed = cut_lineage(significant(_kruskal(ranks, analyte), "p", alpha))
    concerned = null_safe_join(ranks, passed.select(*analyte), analyte, "left_semi")
    return {
        "kruskal": passed.drop("ties"),
        "dunn": significant(_dunn(concerned, analyte), "p_adjusted", alpha, inclusive=True),
    }


def _tally_by_factor(df: DataFrame, analyte: list[str], factors: list[str], value: str) -> DataFrame:
    """``_tally`` of every factor from one pass: rows ``n`` per factor, analyte, value and level; unknown levels go.

    Equal rows meet before the rows are multiplied, in tasks that Spark doesn't merge, so a task tallies a part of the values only.
    """
    present = df.filter(F.col(value).isNotNull()).select(
        *analyte, F.col(value).cast("double").alias("value"), *[F.col(f).cast("string").alias(f) for f in factors]
    ).repartition(session_partitions(df.sparkSession), *analyte, "value", *factors)
    common = [F.col(c) for c in [*analyte, "value"]]
    counted = present.groupingSets(
        [[*common, F.col(f)] for f in factors], *common, *[F.col(f) for f in factors]
    ).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(f).alias(f"_no_{k}") for k, f in enumerate(factors)])
    own = [F.when(F.col(f"_no_{k}") == 0, F.struct(F.lit(f).alias("factor"), F.col(f).alias("group"))) for k, f in enumerate(factors)]
    named = counted.select(*analyte, "value", "n", F.coalesce(*own).alias("_own"))
    return drop_unknown(named.select(F.col("_own.factor").alias("factor"), *analyte, "value", F.col("_own.group").alias("group"), "n"), "group")


def group_tests_by_factor(
    df: DataFrame, analyte: list[str], factors: list[str], value: str, alpha: float = 0.05
) -> DataFrame:
    """Both test families for every factor in one long result.

    Omnibus rows (``anova``, ``kruskal``) carry no groups; pair rows (``tukey``, ``duncan``,
    ``dunn``) belong to analytes whose omnibus test passed. The rows are read once, into one tally for all factors.
    """
    keys = ["factor", *analyte]
    tallied = cut_lineage(_tally_by_factor(df, analyte, factors, value))
    tests = _posthoc(_moments(tallied, keys), keys, alpha) | _rank_posthoc(_rank_summary(tallied, keys), keys, alpha)
    statistic: dict[str, Column] = {"anova": F.col("f"), "kruskal": F.col("h"), "dunn": F.col("z")}
    none = F.lit(None).cast("string")
    rows = [
        table.select(
            *keys, F.lit(name).alias("test"),
            *([F.col("group1"), F.col("group2")] if "group1" in table.columns
              else [none.alias("group1"), none.alias("group2")]),
            statistic.get(name, F.col("q") if "q" in table.columns else F.lit(None)).alias("statistic"),
            F.col("p_adjusted" if name == "dunn" else "p").alias("p"),
        )
        for name, table in tests.items()
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out
