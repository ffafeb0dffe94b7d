"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. All its documents are taken ``whole`` times for certain; the
rest of the target is filled with documents in the order of their Pareto rank, the odds of a uniform
draw divided by the odds of inclusion, as far as the target allows, and the gap below it with documents
that fit in. The cuts are kept as a few ranks per source, so texts are neither sorted nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import BLANKS, cut_lineage, join_small, null_safe_join
from assayspark.operators.scale import in_slices, running

WORD = BLANKS.replace("[", "[^", 1)
MOST_COPIES = 3
SOURCE_BYTES = 256
ROUNDS = 4


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *columns: Column) -> Column:
    """A number above 0 and below 1 that depends on the columns and the seed alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """One row per source: source, source_size, target.

    ``sizes`` has columns source and size. Sources by code point, NULL last, take the ``weights`` in
    turn. A target above MOST_COPIES times its source is cut to it, and the excess goes to the others
    by weight, until none is above. All sizes 0 gives targets of 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumns({"unnamed": F.col("source").isNull(), "one": F.lit(1)})
    order = ["unnamed", "source"]
    ranked = running(in_slices(ordered, [], order), [], order, sums={"rank": "one"})
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = cut_lineage(ranked.select("source", "source_size", turn.cast("double").alias("weight")))
    cap = F.col("source_size") * F.lit(float(MOST_COPIES))
    wanted = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.lit(capped >= 0) & (F.col("weight") * F.lit(level) > cap)
        number, used, free = weighed.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
        ).first()
        if number == capped or not free:
            break
        capped, level = number, (share * wanted - used) / free
    return weighed.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, seed: int = 7,
    favour: Column | None = None,
) -> DataFrame:
    """One row per source: source_size, target, whole copies of every document, and the cuts of the drawn ones.

    A document is drawn if for one of the ROUNDS its size is at most the limit and its rank at most the cut.
    The first round has no limit; each later one fills the gap that the one before left below the target, with
    documents that fit in. ``last`` is the rank of one more document, where that brings the sum nearer to the target.
    """
    sized = docs.select(F.col("source"), word_count(F.col("text")).alias("size"), _draw(seed).alias("draw"),
                        _favour(favour).alias("favour"))
    kept = cut_lineage(sized)
    targets = source_targets(kept, weights, share)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = cut_lineage(targets.withColumn("whole", F.floor(ratio)).withColumns({
        "part": ratio - F.col("whole"),
        "rest": F.col("target") - F.col("whole") * F.col("source_size"),
        "limits": F.array().cast("array<double>"), "cuts": F.array().cast("array<double>"),
    }))
    ranked = join_small(kept, plan.select("source", "part"), ["source"], "inner", SOURCE_BYTES).filter("size > 0")
    ranked = ranked.withColumn("rank", pareto_rank(F.col("draw"), F.col("part"), F.col("favour")))
    order = ["rank", "size"]
    sliced = in_slices(ranked.filter(F.col("rank").isNotNull()).select("source", *order), ["source"], order)
    for turn in range(ROUNDS):
        limit = F.col("rest") if turn else F.lit(float("inf"))
        beyond = F.coalesce(F.get("cuts", F.lit(turn - 1)), F.lit(-1.0)) if turn else F.lit(-1.0)
        open_ = plan.select("source", F.col("rest").alias("_rest"), limit.alias("_limit"), beyond.alias("_beyond"))
        fitting = join_small(sliced, open_, ["source"], "inner", SOURCE_BYTES).filter(
            (F.col("size") <= F.col("_limit")) & (F.col("rank") > F.col("_beyond"))
        )
        filled = running(fitting, ["source"], order, sums={"upto": "size"}).filter(F.col("upto") <= F.col("_rest"))
        got = filled.groupBy("source").agg(F.max("rank").alias("_cut"), F.max("upto").alias("_got"))
        cut = F.coalesce("_cut", beyond)
        plan = cut_lineage(null_safe_join(plan, got, ["source"]).select(
            "source", "source_size", "target", "whole", "part",
            (F.col("rest") - F.coalesce("_got", F.lit(0))).alias("rest"),
            F.array_append("limits", limit).alias("limits"), F.array_append("cuts", cut).alias("cuts"),
        ))
    rounds = plan.select("source", "rest", F.struct("limits", "cuts").alias("plan"))
    left = join_small(sliced, rounds, ["source"], "inner", SOURCE_BYTES)
    gap = F.abs(F.col("size") - F.col("rest"))
    nearest = left.filter(~_drawn(F.col("size"), F.col("rank"), F.col("plan")) & (gap < F.col("rest"))).groupBy("source").agg(
        F.min_by("rank", F.struct(gap, "rank")).alias("last")
    )
    return cut_lineage(null_safe_join(plan, nearest, ["source"]))


def _drawn(size: Column, rank: Column, plan: Column) -> Column:
    """Whether one of the plan's rounds takes a row."""
    rounds = F.arrays_zip(plan["limits"].alias("limits"), plan["cuts"].alias("cuts"))
    return F.exists(rounds, lambda c: (size <= c["limits"]) & (rank <= c["cuts"]))


def pareto_rank(draw: Column, part: Column, favour: Column) -> Column:
    """Odds of the draw over odds of inclusion; ``favour`` multiplies the latter. NULL where nothing is drawn."""
    odds = part / (F.lit(1.0) - part) * favour
    return F.when(part > 0, draw / (F.lit(1.0) - draw) / odds)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, seed: int = 7,
    favour: Column | None = None,
) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_copies; columns that begin with mix_ are replaced.

    ``favour`` is a positive column that multiplies a document's odds of inclusion; NULL or values
    that are not positive count as 1. A null source is a source of its own. A null or empty text has
    size 0 and neither fills a target nor counts. Rows that repeat in full share rank and fate; a
    source whose documents are all empty has target 0. No rows give no rows.
    """
    plan = mix_plan(docs, weights, share, seed, favour).select(
        F.col("source"), F.struct("source_size", "target", "whole", "part", "limits", "cuts", "last").alias("mix_plan")
    )
    rows = docs.withColumns({"mix_size": word_count(F.col("text")), "mix_draw": _draw(seed), "mix_favour": _favour(favour)})
    joined = join_small(rows, plan, ["source"], "left", SOURCE_BYTES)
    known = F.col("mix_plan")
    rank = pareto_rank(F.col("mix_draw"), known["part"], F.col("mix_favour"))
    drawn = (F.col("mix_size") > 0) & (
        _drawn(F.col("mix_size"), rank, known) | (rank == F.coalesce(known["last"], F.lit(-1.0)))
    )
    return joined.withColumns({
        "mix_copies": known["whole"] + F.coalesce(drawn, F.lit(False)).cast("long"),
        "mix_source_size": known["source_size"], "mix_target": known["target"],
    }).drop("mix_plan", "mix_draw", "mix_favour")


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Each document as many times as the mix takes it, with its own columns only."""
    own = [c for c in mixed.columns if not c.startswith("mix_")]
    times = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int")))
    return mixed.withColumn("mix_copy", times).select(*own)


def _draw(seed: int) -> Column:
    return uniform(seed, F.col("doc_id"), F.col("text"))


def _favour(favour: Column | None) -> Column:
    given = F.lit(1.0) if favour is None else favour.cast("double")
    return F.coalesce(F.when(given > 0, given), F.lit(1.0))
