"""Hot keys, many slices, the paths beyond the size checks, and the shape of plans."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayspark.operators import correlation, frames, groups, longitudinal, ranks, scale
from assayspark.operators.correlation import cross_correlation


@pytest.fixture
def many_slices(spark):
    """Keep every range partition, so that a hot key really spreads over slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def skewed(spark, rows=4000):
    """Half of the rows belong to one key, a third of those share one value."""
    rng = random.Random(7)
    data = []
    for i in range(rows):
        key = "hot" if i % 2 else f"k{i % 9}"
        data.append((key, 1.0 if key == "hot" and i % 3 == 0 else round(rng.random() * 50, 3 if key == "hot" else 1), f"g{i % 3}"))
    return data, spark.createDataFrame(data, "key string, v double, g string")


def brute_ranks(values):
    order = np.sort(np.array(values))
    return {v: (np.searchsorted(order, v) + np.searchsorted(order, v, "right") + 1) / 2 for v in set(values)}


def test_ranks_of_a_hot_key_over_slices(spark, many_slices):
    data, df = skewed(spark)
    sliced = scale.in_slices(df.groupBy("key", "v").agg(F.count(F.lit(1)).alias("n")), ["key"], ["v"])
    assert sliced.filter("key = 'hot'").select(scale.SLICE).distinct().count() > 1
    found = {(r.key, r.v): r["rank"] for r in scale.average_ranks(df, ["key"], "v").collect()}
    for key in {k for k, _, _ in data}:
        for value, rank in brute_ranks([v for k, v, _ in data if k == key]).items():
            assert found[(key, value)] == rank


@pytest.mark.parametrize("hot", [1.0, None])
def test_row_ranks_of_a_hot_value_spread_over_slices(spark, many_slices, hot):
    """One value (or NULL) has a third of the rows: its rows are in many slices, and no join is on a value."""
    rng = random.Random(3)
    data = [("k" if i % 5 else "other", hot if i % 3 == 0 else float(rng.randint(-9, 9)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "key string, v double, i int").repartition(7)
    placed = scale.placed_rows(df.filter("v is not null"), ["key"], "v")
    if hot:
        assert placed.filter("v = 1 and key = 'k'").select(scale.SLICE).distinct().count() > 1
    found = ranks.rank_avg(df, ["key"], "v").collect()
    assert len(found) == len(data)
    for key in ("k", "other"):
        mine = [v for k, v, _ in data if k == key and v is not None]
        expected = brute_ranks([-v for v in mine])
        for r in found:
            if r.key == key:
                assert r["rank"] == (None if r.v is None else expected[-r.v])
    dense = {v: n for n, v in enumerate(sorted({v for _, v, _ in data if v is not None}), 1)}
    for r in scale.placed_rows(df.filter("v is not null"), [], "v").collect():
        assert r["_dense"] == dense[r.v] and r["_all"] == sum(v is not None for _, v, _ in data)
    assert not re.search(r"Join \[[^\n]*\bv#", plan(ranks.rank_avg(df, ["key"], "v")))


def test_adjusted_p_of_a_hot_value(spark, many_slices):
    rng = random.Random(4)
    data = [("f" if i % 4 else "g", 1.0 if i % 3 == 0 else None if i % 7 == 0 else round(rng.random(), 2)) for i in range(900)]
    df = spark.createDataFrame(data, "family string, p double").repartition(5)
    found = groups.p_adjust_bh(df, "p", ["family"]).collect()
    assert len(found) == 900
    for family in ("f", "g"):
        own = sorted(p for f, p in data if f == family and p is not None)
        raw = {p: min(1.0, p * len(own) / sum(q <= p for q in own)) for p in own}
        for r in found:
            if r.family == family and r.p is not None:
                assert r.p_adjusted == pytest.approx(min(v for q, v in raw.items() if q >= r.p))
            assert (r.p is None) == (r.p_adjusted is None)


def test_one_tally_for_all_factors(spark):
    rng = random.Random(5)
    rows = [(f"a{i % 3}", rng.choice(["x", "y", "unknown", None]), rng.choice("pqr"), round(rng.gauss(5, 1), 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "a string, f string, g string, v double")
    tallied = groups._tally_by_factor(df, ["a"], ["f", "g"], "v")
    found = {(r.factor, r.a, r.group): r.n for r in tallied.groupBy("factor", "a", "group").agg(F.sum("n").alias("n")).collect()}
    for k, name in ((1, "f"), (2, "g")):
        for level in {r[k] for r in rows} - {"unknown", None}:
            for a in ("a0", "a1", "a2"):
                assert found.pop((name, a, level)) == sum(r[0] == a and r[k] == level for r in rows)
    assert not found
    kept = scale.cut_lineage(tallied)
    by_tally = groups._anova(groups._moments(kept, ["factor", "a"]), ["factor", "a"]).filter("factor = 'g'").orderBy("a").collect()
    plain = groups.anova_oneway(df, ["a"], "g", "v").orderBy("a").collect()
    assert [(r.n, r.df2) for r in by_tally] == [(r.n, r.df2) for r in plain]
    assert [r.f for r in by_tally] == pytest.approx([r.f for r in plain])


def test_deviations_from_summaries(spark):
    rng = random.Random(6)
    rows = [(s, f"a{k}", t, None if s == 5 and k == 1 and t == 2 else 1e6 + rng.random()) for s in range(9) for k in range(3)
            for t in range(1 + s % 3) for _ in range(2)]
    df = spark.createDataFrame(rows, "s int, a string, t int, concentration_ug_ml double")
    args = (df, "s", ["a"], "t", ["-concentration_ug_ml"])
    slow = longitudinal.sd_ratio(longitudinal.longitudinal(*args), "s", ["a"]).orderBy("s", "a").collect()
    fast = longitudinal.subject_deviations(*args).orderBy("s", "a").collect()
    assert [(r.s, r.a) for r in fast] == [(r.s, r.a) for r in slow]
    for x, y in zip(fast, slow, strict=True):
        for c in ("group_sd", "total_sd", "sdr"):
            assert (x[c] is None) == (y[c] is None) and (x[c] is None or x[c] == pytest.approx(y[c], rel=1e-6))
    none = longitudinal.subject_deviations(*args, study=spark.range(99).select(F.col("id").cast("string").alias("a")))
    assert none.count() == 0


def test_correlation_holds_one_tile_at_a_time(monkeypatch):
    import pandas as pd

    held, most = set(), []
    build = correlation._Tile.__init__

    def counted(self, tile):
        held.clear()
        held.add(tile)
        most.append(len(held))
        build(self, tile)

    monkeypatch.setattr(correlation._Tile, "__init__", counted)
    rows = [(a, b, [a, b], [f"i{a}", f"j{b}"], [1.0, 2.0]) for a in range(6) for b in range(a, 6) for _ in range(3)]
    frames_in = [pd.DataFrame(rows[k:k + 5], columns=["tile_a", "tile_b", "blocks", "items", "amounts"]) for k in range(0, len(rows), 5)]
    out = pd.concat(correlation._partial_products(iter(frames_in)))
    assert len(most) == 21 and max(most) == 1
    assert (out.groupby(["a", "b"]).size() == 1).sum() > 20 and set(out["xy"]) == {3.0, 6.0, 12.0}


def test_running_minimum_from_the_top(spark, many_slices):
    data, df = skewed(spark)
    numbered = df.groupBy("key", "v").agg(F.min("g").alias("g")).withColumn("x", F.pmod(F.xxhash64("v"), F.lit(97)))
    rows = scale.running(scale.in_slices(numbered, ["key"], ["v"]), ["key"], ["v"], mins={"low": "x"},
                         totals={"all": "x"}, from_top=True).collect()
    hot = sorted((r for r in rows if r.key == "hot"), key=lambda r: -r.v)
    low = None
    for r in hot:
        low = r.x if low is None else min(low, r.x)
        assert r.low == low and r.all == sum(h.x for h in hot)


@pytest.mark.parametrize("weight", [None, "n"])
def test_attach_beyond_the_broadcast_limit(spark, weight):
    _, df = skewed(spark)
    summary = df.groupBy("key").agg(F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"))
    if weight is None:
        summary = summary.drop("n")
    small = scale.attach(df, summary, ["key"], rows_per_key=weight)
    large = scale.attach(df, summary, ["key"], rows_per_key=weight, broadcast_rows=0)
    assert large.columns == small.columns
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    some = summary.filter("key != 'hot'")
    assert scale.attach(df, some, ["key"], "left_anti", broadcast_rows=0, rows_per_key=weight).count() == 2000


def test_kruskal_is_the_same_over_slices(spark, many_slices):
    _, df = skewed(spark)
    many = groups.kruskal_wallis(df.repartition(5), ["key"], "g", "v").orderBy("key").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    few = groups.kruskal_wallis(df, ["key"], "g", "v").orderBy("key").collect()
    assert [r.h for r in many] == pytest.approx([r.h for r in few])


def test_quartiles_of_a_hot_key(spark, many_slices):
    data, df = skewed(spark)
    for r in frames.grouped_quartiles(df, ["key"], "v").collect():
        values = [v for k, v, _ in data if k == r.key]
        assert (r.q1, r.median, r.q3) == pytest.approx(tuple(np.percentile(values, [25, 50, 75])))
        assert r.n == len(values) and r["mean"] == pytest.approx(np.mean(values))


def test_qq_copies_frequent_values_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(frames, "COPIES_PER_TASK", 10)
    data, df = skewed(spark, 600)
    rows = frames.qq_frame(df, "v", ["key"]).filter("key = 'hot'").orderBy("place").collect()
    assert [r.place for r in rows] == list(range(1, 301))
    assert [r.value for r in rows] == sorted(v for k, v, _ in data if k == "hot")


def test_correlation_in_tiles_matches_numpy(spark):
    rng = np.random.default_rng(3)
    cells = [(r, f"i{c}", float(round(rng.normal(), 2))) for r in range(40) for c in range(7) if rng.random() < 0.8]
    matrix = np.zeros((40, 7))
    for r, item, v in cells:
        matrix[r, int(item[1:])] = v
    expected = np.corrcoef(matrix.T)
    df = spark.createDataFrame(cells, "r int, item string, v double")
    for tile_items in (1024, 2):
        found = cross_correlation(df, ["r"], "item", "v", tile_items=tile_items).collect()
        assert len(found) == 49
        for row in found:
            assert row.correlation == pytest.approx(expected[int(row.item[1:]), int(row.combination[1:])], abs=1e-9)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["kruskal_wallis", "auc", "roc_curve", "tidify", "anova_oneway", "paired_t"])
def test_plans_without_cross_join_or_global_window(spark, name):
    from __spark_entry__ import queries

    text = plan(queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Window \[[^\n]*\], *\[[^\]]*\]\n[^\n]*\n[^\n]*SinglePartition", text)


def test_scan_reads_needed_columns_only(spark):
    from __spark_entry__ import queries

    text = plan(queries()["group_counts"](spark, "/root/testdata/sf0.001"))
    assert "l_extendedprice" not in text and "l_tax" not in text


def test_equal_rows_of_a_hot_key_are_split(spark, monkeypatch):
    monkeypatch.setattr(scale, "ROWS_PER_PIECE", 100)
    df = spark.range(3000).select(F.lit("hot").alias("key"), F.lit(1).alias("v"))
    joined = scale.attach(df, df.groupBy("key").agg(F.count(F.lit(1)).alias("n")), ["key"], broadcast_rows=0)
    assert joined.count() == 3000 and joined.filter("n = 3000").count() == 3000


def test_lookups_run_no_job_while_built(spark):
    from assayspark.operators import joins, replicates

    rows = spark.range(10).select(F.col("id").alias("run"), F.lit("s").alias("set"), F.col("id").cast("double").alias("v"))
    spark.sparkContext.setJobGroup("lookups", "lookups while they are built")
    try:
        joined = joins.enrich_left(rows, rows.select("run", F.lit(1).alias("n")), "run")
        first = joins.lookup_first(joined, rows.select("run", F.lit(2).alias("m")), "run", ["m"], ["m"])
        left = joins.drop_botched(first, rows.filter("run < 3"))
        related = replicates.relative_to_max(left, "v", "share")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookups")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.run, r.n, r.m, r.share) for r in related.collect()) == [(k, 1, 2, k / 9) for k in range(3, 10)]


def test_measured_bytes_decide_about_broadcasts(spark, monkeypatch):
    wide = scale.cut_lineage(spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("list")))
    n, size = scale.measured(wide)
    assert n == 100 and 100_000 < size < 120_000
    assert scale.measured(wide.limit(0)) == (0, 0)
    assert scale.fits_broadcast(wide)
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 50_000)
    assert not scale.fits_broadcast(wide)


def test_released_tables_are_gone(spark):
    kept = scale.cut_lineage(spark.range(5))
    path = kept.inputFiles()[0]
    scale.release(kept)
    with pytest.raises(Exception, match="(?i)not.*exist|no such"):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError, match="no table of this application"):
        scale.release(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_windows_over_slices_get_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(scale, "ROWS_PER_TASK", 100)
    rows = spark.range(2000).select(F.lit("k").alias("key"), (F.col("id") % 50).cast("double").alias("v"))
    ranked = ranks.rank_avg(rows, ["key"], "v")
    assert re.search(r"hashpartitioning\(key#\d+, _slice#\d+, 20\), REPARTITION_BY_NUM", plan(ranked))
    assert sorted({r["rank"] for r in ranked.collect()}) == [20.5 + 40 * k for k in range(50)]


def test_pairs_are_joined_once_for_all_statistics(spark):
    """The table of statistics comes from written tables: nothing of the source is read a second time."""
    from __spark_entry__ import queries

    files = queries()["volcano_flags"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "testdata" in f]


def test_tallies_by_factor_are_dealt_before_rows_multiply(spark):
    df = spark.createDataFrame([("a", "x", "p", 1.0)], "a string, f string, g string, v double")
    assert re.search(r"Expand[^$]*REPARTITION_BY_NUM", plan(groups._tally_by_factor(df, ["a"], ["f", "g"], "v")))


def test_followed_subjects_are_dealt_once(spark):
    from assayspark.plans import tables

    text = plan(tables.followed_subjects(spark, "/root/testdata/sf0.001"))
    assert re.search(r"REPARTITION_BY_NUM", text) and not re.search(r"hashpartitioning\([^)]*year", text)
