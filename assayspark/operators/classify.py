"""Single-marker classifiers: logistic fit, scores, confusion, ROC and area for every analyte at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.functions.expressions import logistic, logit_cutoff
from assayspark.operators.reshape import train_test_split
from assayspark.operators.scale import (
    attach, average_ranks, cut_lineage, fits_broadcast, in_slices, join_summary, null_safe_join, running,
)

ETA_LIMIT = 30.0


def _inputs(df: DataFrame, analyte: list[str], x: str, y: str) -> DataFrame:
    whole = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return whole.groupBy(*analyte, F.col(x).cast("double").alias("x"), F.col(y).cast("int").alias("y")).agg(
        F.count(F.lit(1)).cast("double").alias("w")
    )


def _start(inputs: DataFrame, analyte: list[str]) -> DataFrame:
    """Centre, scale and starting line: least squares of the working response on the scaled x.

    Starting means of 3/4 and 1/4 give the working response +-(ln 3 + 4/3) and the deviance below.
    """
    response = math.log(3.0) + 4.0 / 3.0
    sums = inputs.groupBy(*analyte).agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1"),
        F.sum(F.col("w") * F.col("x")).alias("_sx"),
        F.min(F.when(F.col("y") == 1, F.col("x"))).alias("_low1"),
        F.max(F.when(F.col("y") == 1, F.col("x"))).alias("_high1"),
        F.min(F.when(F.col("y") == 0, F.col("x"))).alias("_low0"),
        F.max(F.when(F.col("y") == 0, F.col("x"))).alias("_high0"),
    ).withColumn("_centre", F.col("_sx") / F.col("n"))
    summary = cut_lineage(sums)
    off = F.col("x") - F.col("_centre")
    moments = attach(inputs, summary.select(*analyte, "_centre"), analyte).groupBy(*analyte).agg(
        F.sum(F.col("w") * off * off).alias("_sxx"), F.sum(F.col("w") * off * F.col("y")).alias("_sxy"),
    )
    both = null_safe_join(summary, moments, analyte)
    scale = F.sqrt(F.col("_sxx") / F.col("n"))
    apart = (F.col("_high0") <= F.col("_low1")) | (F.col("_high1") <= F.col("_low0"))
    usable = (F.col("_sxx") > 0) & (F.col("n1") > 0) & (F.col("n1") < F.col("n"))
    return cut_lineage(both.withColumns({"_scale": scale, "separated": F.coalesce(apart, F.lit(True))}).select(
        *analyte, "n", "n1", "_centre", "_scale", "separated",
        F.when(usable, response * (2 * F.col("n1") / F.col("n") - 1)).alias("_b0"),
        F.when(usable, 2 * response * F.col("_sxy") / F.col("_sxx") * F.col("_scale")).alias("_b1"),
        (2 * F.col("n") * math.log(4.0 / 3.0)).alias("_deviance"),
        (~usable).alias("_done"), F.lit(False).alias("converged"), F.lit(1).alias("iterations"),
    ))


def logistic_fit(
    df: DataFrame, analyte: list[str], x: str, y: str, threshold: float = 0.5, max_iter: int = 25, tol: float = 1e-8
) -> DataFrame:
    """Unregularised logistic regression of a 0/1 label on one variable, per analyte.

    Iteratively reweighted least squares for all analytes together: an iteration is one aggregation
    of five sums per analyte, and an analyte rests once its deviance settles. NULL coefficients where
    x or the label does not vary; ``separated`` where a cut-off splits the classes without error, so
    that the slope has no finite optimum.
    """
    return _fit(cut_lineage(_inputs(df, analyte, x, y)), analyte, threshold, max_iter, tol)


def _fit(inputs: DataFrame, analyte: list[str], threshold: float, max_iter: int = 25, tol: float = 1e-8) -> DataFrame:
    """``logistic_fit`` from a written tally: analyte, x, y and the rows ``w`` that have them."""
    params = _start(inputs, analyte)
    spread = attach(inputs, params.select(*analyte, "_centre", "_scale"), analyte).select(
        *analyte, F.try_divide(F.col("x") - F.col("_centre"), F.col("_scale")).alias("x"), "y", "w"
    )
    rows = cut_lineage(spread.filter(F.col("x").isNotNull()))
    few = fits_broadcast(params)
    for _ in range(max_iter):
        open_params = params.filter(~F.col("_done"))
        if open_params.isEmpty():
            break
        line = open_params.select(*analyte, "_b0", "_b1")
        scored = join_summary(rows, line, analyte, "inner", few)
        linear = F.col("_b0") + F.col("_b1") * F.col("x")
        eta = F.greatest(F.lit(-ETA_LIMIT), F.least(F.lit(ETA_LIMIT), linear))
        weighted = scored.withColumn("_eta", eta).withColumn("_mu", 1.0 / (1.0 + F.exp(-F.col("_eta"))))
        v = F.col("w") * F.col("_mu") * (1 - F.col("_mu"))
        g = F.col("w") * (F.col("y") - F.col("_mu"))
        signed = F.when(F.col("y") == 1, -F.col("_eta")).otherwise(F.col("_eta"))
        sums = weighted.groupBy(*analyte).agg(
            F.sum(v).alias("_v"), F.sum(v * F.col("x")).alias("_vx"),
            F.sum(v * F.col("x") * F.col("x")).alias("_vxx"),
            F.sum(g).alias("_g"), F.sum(g * F.col("x")).alias("_gx"),
            F.sum(2 * F.col("w") * F.log1p(F.exp(signed))).alias("_new_deviance"),
        )
        determinant = F.col("_v") * F.col("_vxx") - F.col("_vx") * F.col("_vx")
        settled = F.abs(F.col("_new_deviance") - F.col("_deviance")) / (F.lit(0.1) + F.abs(F.col("_new_deviance"))) < tol
        out_of_steps = F.col("iterations") >= max_iter
        step0 = F.try_divide(F.col("_vxx") * F.col("_g") - F.col("_vx") * F.col("_gx"), determinant)
        step1 = F.try_divide(F.col("_v") * F.col("_gx") - F.col("_vx") * F.col("_g"), determinant)
        rests = F.col("_done") | F.coalesce(settled, F.lit(False)) | out_of_steps | step0.isNull()
        joined = null_safe_join(params, sums, analyte).withColumn("_rests", rests)
        params = cut_lineage(joined.select(
            *analyte, "n", "n1", "_centre", "_scale", "separated",
            F.when(F.col("_rests"), F.col("_b0")).otherwise(F.col("_b0") + step0).alias("_b0"),
            F.when(F.col("_rests"), F.col("_b1")).otherwise(F.col("_b1") + step1).alias("_b1"),
            F.coalesce(F.col("_new_deviance"), F.col("_deviance")).alias("_deviance"),
            F.col("_rests").alias("_done"),
            F.when(F.col("_done"), F.col("converged")).otherwise(F.coalesce(settled, F.lit(False))).alias("converged"),
            (F.col("iterations") + F.when(F.col("_rests"), 0).otherwise(1)).alias("iterations"),
        ))
    slope = F.try_divide(F.col("_b1"), F.col("_scale"))
    fitted = params.withColumn("slope", slope).withColumn(
        "intercept", F.col("_b0") - F.col("slope") * F.col("_centre")
    )
    return fitted.select(
        *analyte, F.col("n").cast("bigint").alias("n"), "intercept", "slope",
        logit_cutoff(F.col("intercept"), F.col("slope"), threshold).alias("cutoff"),
        "converged", "separated", "iterations",
    )


def score(df: DataFrame, fits: DataFrame, analyte: list[str], x: str, threshold: float = 0.5) -> DataFrame:
    """Add the fitted probability and the predicted class."""
    joined = attach(df, fits.select(*analyte, "intercept", "slope"), analyte)
    probability = logistic(F.col("intercept"), F.col("slope"), F.col(x))
    return joined.withColumn("probability", probability).drop("intercept", "slope").withColumn(
        "predicted", F.when(F.col("probability").isNotNull(), F.when(F.col("probability") > threshold, 1).otherwise(0))
    )


def confusion_metrics(
    scored: DataFrame, analyte: list[str], label: str, predicted: str = "predicted", digits: int = 2, weight: str | None = None
) -> DataFrame:
    """Counts, accuracy, sensitivity and specificity; a rate without cases is NULL. ``weight`` is the rows a row stands for."""
    def rows(which: Column) -> Column:
        return F.sum(F.when(which, F.col(weight)).otherwise(0)).cast("bigint") if weight else F.count_if(which)

    hit = F.col(predicted) == F.col(label)
    positive = F.col(label) == 1
    counts = scored.filter(F.col(predicted).isNotNull() & F.col(label).isNotNull()).groupBy(*analyte).agg(
        rows(hit & positive).alias("tp"), rows(hit & ~positive).alias("tn"),
        rows(~hit & ~positive).alias("fp"), rows(~hit & positive).alias("fn"),
    )

    def rate(part, whole):
        return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)

    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return counts.withColumns({
        "accuracy": rate(tp + tn, tp + tn + fp + fn),
        "sensitivity": rate(tp, tp + fn),
        "specificity": rate(tn, tn + fp),
    })


def _labelled(df: DataFrame, analyte: list[str], score_col: str, label: str, weight: str | None = None) -> DataFrame:
    known = df.filter(F.col(score_col).isNotNull() & F.col(label).isNotNull())
    rows = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    return known.select(
        *analyte, F.col(score_col).alias("cutoff"), rows.alias("_rows"),
        ((F.col(label) == 1).cast("bigint") * rows).alias("pos"), ((F.col(label) != 1).cast("bigint") * rows).alias("neg"),
    )


def roc_curve(df: DataFrame, analyte: list[str], score_col: str, label: str) -> DataFrame:
    """False and true positive rate and accuracy at every distinct score, from (0, 0) at infinity."""
    tallied = cut_lineage(_labelled(df, analyte, score_col, label).groupBy(*analyte, "cutoff").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    ))
    walked = running(
        in_slices(tallied, analyte, ["cutoff"]), analyte, ["cutoff"], sums={"tp": "pos", "fp": "neg"},
        totals={"_p": "pos", "_n": "neg"}, from_top=True,
    )

    def rates(frame: DataFrame) -> DataFrame:
        p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
        return frame.select(
            *analyte, F.try_divide(F.col("fp").cast("double"), n).alias("fpr"),
            F.try_divide(F.col("tp").cast("double"), p).alias("tpr"), "cutoff",
            F.try_divide(F.col("tp") + n - F.col("fp"), p + n).alias("accuracy"),
        )

    origin = tallied.groupBy(*analyte).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).withColumns({
        "cutoff": F.lit(float("inf")), "tp": F.lit(0), "fp": F.lit(0),
    })
    return rates(walked).unionByName(rates(origin))


def auc(
    df: DataFrame, analyte: list[str], score_col: str, label: str, digits: int | None = 2, weight: str | None = None
) -> DataFrame:
    """Area under the ROC curve from tie-averaged ranks; NULL with a single class. ``weight`` is the rows a row stands for."""
    ranked = average_ranks(
        _labelled(df, analyte, score_col, label, weight), analyte, "cutoff", counts=["pos", "neg"], weight="_rows"
    )
    sums = ranked.groupBy(*analyte).agg(
        F.sum(F.col("rank") * F.col("pos")).alias("_r"),
        F.sum("pos").cast("double").alias("_p"), F.sum("neg").cast("double").alias("_n"),
    )
    p, n = F.col("_p"), F.col("_n")
    area = F.try_divide(F.col("_r") - p * (p + 1) / 2, p * n)
    return sums.select(*analyte, (area if digits is None else F.round(area, digits)).alias("auc"))


def classifier_table(
    df: DataFrame, analyte: list[str], x: str, y: str, threshold: float = 0.5, fit_on: str = "all",
    row_key: list[str] | None = None, fraction: float = 0.3, seed: int = 1354,
) -> DataFrame:
    """Cut-off, accuracy, sensitivity, specificity and area per analyte.

    ``fit_on="all"`` fits and scores all rows. ``"train"`` fits the drawn fraction and scores the
    rest; it needs ``row_key``. The rows are read once, into one tally of x and label per analyte, from which fit, confusion and area
    are worked out. The area ranks x itself, turned where the slope falls, as a probability near 0 or 1 loses its order.
    """
    if fit_on == "train":
        parts = cut_lineage(train_test_split(df, analyte, row_key, fraction, seed))
        train, test = (cut_lineage(_inputs(parts.filter(own), analyte, x, y)) for own in ("is_train", "not is_train"))
    else:
        train = test = cut_lineage(_inputs(df, analyte, x, y))
    fits = cut_lineage(_fit(train, analyte, threshold))
    turned = attach(test, fits.select(*analyte, "intercept", "slope"), analyte)
    scored = cut_lineage(turned.select(
        *analyte, "y", "w", (F.signum("slope") * F.col("x")).alias("_turned"),
        logistic(F.col("intercept"), F.col("slope"), F.col("x")).alias("probability"),
    ).withColumn("predicted", F.when(F.col("probability").isNotNull(), (F.col("probability") > threshold).cast("int"))))
    table = null_safe_join(fits, confusion_metrics(scored, analyte, "y", weight="w"), analyte)
    return null_safe_join(table, auc(scored, analyte, "_turned", "y", weight="w"), analyte).select(
        *analyte, "n", "cutoff", "accuracy", "sensitivity", "specificity", "auc", "converged", "separated"
    )


def merge_performance(biomarkers: DataFrame, classifiers: DataFrame, analyte: list[str]) -> DataFrame:
    performance = classifiers.select(*analyte, "cutoff", "accuracy", "sensitivity", "specificity", "auc")
    return null_safe_join(biomarkers, performance, analyte)


def marker_score(merged: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean of scaled fold change, power, accuracy and area, best first."""
    kept = cut_lineage(merged)
    largest = kept.select(F.when(F.count("mean_fc") == F.count(F.lit(1)), F.max("mean_fc"))).scalar()
    parts = F.try_divide(F.col("mean_fc"), largest) + F.col("power") + F.col("accuracy") + F.col("auc")
    scored = kept.withColumn("score", parts / 4)
    return scored.orderBy(F.desc_nulls_last("score")) if ordered else scored
