"""The registered queries in plain SQL, for another engine to check.

Views are named building blocks; ``using`` puts the ones a query needs in front of it. Probabilities
come from closed forms, finite sums or Simpson's rule, not from the library's own tails.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}
#: Views that are worked out once.
WRITTEN = {"bell", "bell_nodes", "sta_anova", "sta_sgrid", *(f"{name}{k}" for k in range(4) for name in ("range", "nodes"))}


def view(name: str, needs: str, body: str) -> None:
    VIEWS[name] = (tuple(needs.split()), body)


def using(needs: str, select: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return select
    blocks = ",\n".join(f"{name} AS {'MATERIALIZED ' * (name in WRITTEN)}({VIEWS[name][1]})" for name in ordered)
    return f"WITH RECURSIVE {blocks}\n{select}"


def r(*columns: str, digits: int = 6, nudge: float = 0.0) -> str:
    """Rounded output columns; ``expression AS name`` keeps its name. A nudge settles exact ties."""
    out = []
    for c in columns:
        expression, _, name = c.partition(" AS ")
        value = f"({expression}) + {nudge}::DOUBLE" if nudge else expression
        out.append(f"round({value}, {digits}) + 0.0 AS {name or c}")
    return ", ".join(out)


def decimal_round(column: str, digits: int) -> str:
    """Half-up rounding of a double's decimal text, free of binary representation error."""
    return f"round(CAST(CAST({column} AS VARCHAR) AS DECIMAL(30, 15)), {digits})"


def big(*columns: str) -> str:
    out = []
    for c in columns:
        expression, _, name = c.partition(" AS ")
        out.append(f"CAST({expression} AS BIGINT) AS {name or c}")
    return ", ".join(out)


def strict(aggregate: str, column: str, name: str | None = None) -> str:
    return f"CASE WHEN count({column}) = count(*) THEN {aggregate}({column}) END AS {name or column}"


def oracle(name: str, needs: str, select: str) -> None:
    ORACLES[name] = using(needs, select)


# Base views

view("items", "", """
    SELECT l.*, p.p_brand, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey""")
view("citems", "items", """
    SELECT i.*, c.c_nationkey, c.c_mktsegment FROM items i JOIN customer c ON c.c_custkey = i.o_custkey""")
view("info", "", """
    SELECT p_brand AS peptide, 'P_' || p_brand AS protein, avg(p_retailprice) AS mw, min(p_type) AS stage_specificity
    FROM part GROUP BY p_brand""")
view("amounts", "", """
    SELECT p_brand AS peptide, avg(p_size::DOUBLE) AS fmol_ug, avg(p_retailprice) * 1e-4 AS loq_ug_ml,
           avg(p_retailprice) * 5e-5 AS lod
    FROM part GROUP BY p_brand""")
view("report", "citems", """
    SELECT p_brand AS peptide, n.n_regionkey::VARCHAR AS subject_id, c_mktsegment AS condition,
           l_returnflag AS fragment_ion, l_linenumber::BIGINT AS run,
           CASE WHEN l_linestatus = 'F' THEN 'heavy' ELSE 'light' END AS isotope,
           avg(l_extendedprice) AS area, avg(l_tax) AS background, max(l_extendedprice) AS max_height,
           avg(l_quantity) AS retention_time, avg(l_discount) AS lth, 1 - avg(l_discount) AS rdotp,
           max(l_quantity) AS precursor_mz, min(l_quantity) AS product_mz
    FROM citems i JOIN nation n ON n.n_nationkey = i.c_nationkey GROUP BY ALL""")
view("long", "report info amounts", """
    SELECT r.* REPLACE (CASE WHEN background = 0 OR background IS NULL THEN 1 ELSE background END AS background),
           i.protein, a.fmol_ug, a.fmol_ug * 40 AS fmol_ul, a.loq_ug_ml, a.lod,
           subject_id::DOUBLE + 1 AS curvepoint, '1' AS timepoint,
           CASE fragment_ion WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS transition_rank,
           'H' || subject_id AS histology, 'T' || fragment_ion AS tese, 'X' || run AS texlevel,
           run || '_S' || subject_id || '_' || condition || '_rep' || run AS replicate_name,
           concat_ws('|', peptide, subject_id, condition, fragment_ion, run, isotope) AS row_id
    FROM report r LEFT JOIN info i USING (peptide) LEFT JOIN amounts a USING (peptide)""")

MEASURES = ["area", "background", "max_height", "transition_rank", "retention_time", "precursor_mz", "product_mz"]
WIDE = [f"{i}_{m}" for i in ("heavy", "light") for m in MEASURES]
view("tidy", "long", f"""
    SELECT subject_id, condition, timepoint, curvepoint, run, peptide, fragment_ion,
           {", ".join(f"max({m}) FILTER (isotope = '{i}') AS {i}_{m}" for i in ("heavy", "light") for m in MEASURES)},
           {", ".join(f"arg_min({c}, row_id) AS {c}" for c in
                      ("protein", "replicate_name", "lth", "rdotp", "fmol_ug", "fmol_ul", "loq_ug_ml", "lod",
                       "histology", "tese", "texlevel"))},
           min(row_id) AS row_id
    FROM long GROUP BY subject_id, condition, timepoint, curvepoint, run, peptide, fragment_ion""")

AVERAGED = [
    "heavy_retention_time", "light_retention_time", "heavy_area", "light_area", "heavy_background",
    "light_background", "heavy_max_height", "light_max_height", "rdotp", "lth",
]


def means_of(source: str) -> str:
    first = ["heavy_transition_rank", "run", "protein", "histology", "tese", "texlevel", "fmol_ul", "loq_ug_ml", "lod"]
    return f"""
    SELECT subject_id, condition, timepoint, curvepoint, peptide, fragment_ion,
           {", ".join(strict("avg", c) for c in AVERAGED)},
           {", ".join(f"(arg_min({{'v': {c}}}, row_id)).v AS {c}" for c in first)}, min(row_id) AS row_id
    FROM {source} GROUP BY subject_id, condition, timepoint, curvepoint, peptide, fragment_ion"""


def concentrations_of(means: str) -> str:
    ranked = "heavy_transition_rank = 1"
    averages = ", ".join(
        f"CASE WHEN count({c}) FILTER ({ranked}) = count(*) FILTER ({ranked}) THEN avg({c}) FILTER ({ranked}) END AS {c}"
        for c in AVERAGED
    )
    first = ["run", "histology", "tese", "texlevel", "fmol_ul", "loq_ug_ml", "lod"]
    return f"""
    SELECT g.*, i.protein, i.mw AS molecular_weight, i.stage_specificity,
           abs(light_retention_time - heavy_retention_time) AS lh_rt_diff,
           heavy_area / nullif(heavy_background, 0) AS heavy_snr, light_area / nullif(light_background, 0) AS light_snr,
           lth * fmol_ul AS concentration_fm_ul, lth * fmol_ul * i.mw * 1e-6 AS concentration_ug_ml
    FROM (SELECT subject_id, condition, timepoint, curvepoint, peptide, count(*) FILTER ({ranked}) AS quantifiers,
                 {averages}, {", ".join(f"arg_min({c}, row_id) AS {c}" for c in first)}
          FROM {means} GROUP BY subject_id, condition, timepoint, curvepoint, peptide) g
    LEFT JOIN info i USING (peptide) WHERE quantifiers > 0"""


view("means", "tidy", means_of("tidy"))
view("conc", "means info", concentrations_of("means"))

EXPERIMENT_LABEL = (
    "coalesce(subject_id, 'NA') || '_' || condition || '_' || timepoint || '_' || curvepoint::BIGINT || '_tables'"
)
MT_LABEL = (
    f"{EXPERIMENT_LABEL} || '_' || run || '_' || peptide || '_2+-->' || fragment_ion || '_1+'"
)
EXPERIMENT = "subject_id, condition, timepoint, " + r("curvepoint")

oracle("tidify", "tidy", f"""
    SELECT {MT_LABEL} AS measurement_transition_label, protein, replicate_name,
           {r("lth", "rdotp", *[w for w in WIDE if "rank" not in w])},
           {big("heavy_transition_rank", "light_transition_rank")} FROM tidy""")
oracle("pivot_single", "", f"""
    SELECT l_suppkey, {", ".join(f"round(avg(l_extendedprice) FILTER (l_returnflag = '{v}'), 6) + 0.0 AS {v}" for v in "ANR")}
    FROM lineitem GROUP BY l_suppkey""")
oracle("pivot_levels", "", f"""
    SELECT o_custkey, {", ".join(f"round(avg({c}) FILTER (o_orderstatus = '{v}'), 6) + 0.0 AS {v}{c[0].upper()}{c[1:]}"
                                 for v in "FOP" for c in ("o_totalprice", "o_orderkey"))}
    FROM orders GROUP BY o_custkey""")
oracle("unpivot", "", f"""
    SELECT p_partkey, 'size' AS measure, {r("p_size::DOUBLE AS value")} FROM part
    UNION ALL SELECT p_partkey, 'p_retailprice', {r("p_retailprice AS value")} FROM part""")
oracle("normalise_columns", "", f"""
    SELECT s_suppkey AS supplier_key, {big("s_nationkey")}, {r("s_acctbal AS balance")} FROM supplier""")
oracle("load_assay_set", "long", f"""
    SELECT {MT_LABEL} AS measurement_transition_label, isotope, 'tables' AS "set", run, run AS trial, protein,
           {r("area", "background", "max_height", "lth", "rdotp", "retention_time", "fmol_ug", "fmol_ul", "loq_ug_ml", "lod")},
           {big("transition_rank")}
    FROM long WHERE run NOT IN (SELECT r_regionkey + 4 FROM region)""")
oracle("fill_defaults", "", f"""
    SELECT l_orderkey, l_partkey, {r("coalesce(nullif(l_extendedprice, 0), 0) AS area",
           "coalesce(nullif(nullif(l_tax, 0.08), 0), 1) AS background", "coalesce(nullif(l_discount, 0.05), 0) AS lth",
           "coalesce(nullif(l_tax, 0.01), 0) AS rdotp", "coalesce(nullif(l_quantity, 7), 0) AS max_height",
           "coalesce(nullif(l_quantity, 1), 0) AS retention_time")},
           {big("coalesce(nullif(l_linenumber, 7), 0) AS transition_rank")} FROM lineitem""")
oracle("ratio_fallback", "", f"""
    SELECT l_orderkey, l_partkey, {r("CASE WHEN nullif(l_discount, 0.05) = 0 THEN l_tax / nullif(l_quantity - 1, 0) ELSE nullif(l_discount, 0.05) END AS lth",
           "l_tax AS light_area", "l_quantity - 1 AS heavy_area")} FROM lineitem""")
oracle("extract_run", "", """
    SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN 'x_rep' ELSE l_suppkey || '_S_rep' || l_linenumber END AS replicate_name,
           CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS run FROM lineitem""")
oracle("extract_trial", "", f"""
    SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN '12_rep' ELSE '12_S_rep' || l_linenumber || 'x' END AS replicate_name,
           {big("CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS trial")} FROM lineitem""")
oracle("extract_curve_point", "", f"""
    SELECT p_partkey, 'a_P' || p_size || sep || p_partkey || '-1' AS replicate_name,
           {r("CASE sep WHEN '_' THEN (p_size || '.' || p_partkey)::DOUBLE WHEN '' THEN (p_size || '' || p_partkey)::DOUBLE END AS curvepoint")}
    FROM (SELECT p_partkey, p_size, CASE p_size % 3 WHEN 0 THEN '_' WHEN 1 THEN '__' ELSE '' END AS sep FROM part)""")
oracle("composite_keys", "long", """
    SELECT row_id, sample_label, experiment_label, experiment_label || '_' || run AS measurement_label,
           precursor_name, transition_name, experiment_label || '_' || transition_name AS experiment_transition_label,
           experiment_label || '_' || peptide AS experiment_peptide_label,
           experiment_label || '_' || run || '_' || transition_name AS measurement_transition_label
    FROM (SELECT *, sample_label || '_' || curvepoint::BIGINT || '_tables' AS experiment_label,
                 precursor_name || '-->' || fragment_ion || '_1+' AS transition_name
          FROM (SELECT *, coalesce(nullif(subject_id, '3'), 'NA') || '_' || condition || '_' || timepoint AS sample_label,
                       peptide || '_2+' AS precursor_name FROM long))""")
oracle("select_first", "", f"""
    SELECT {r("s_acctbal")}, s_name, s_suppkey, {big("s_nationkey")} FROM supplier""")
oracle("firstcap", "", "SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS capped FROM part")
oracle("percent", "", """
    SELECT l_orderkey, l_partkey, CASE WHEN l_tax > 0 THEN printf('%.2f', round(100 * (l_discount + l_tax), 2)) || '%' END AS share
    FROM lineitem""")
oracle("spike_concentration", "", f"""
    SELECT p_partkey, {r("p_size::DOUBLE AS fmol_ug", "p_size * 40.0::DOUBLE AS fmol_ul")} FROM part""")
oracle("signal_to_noise", "means", f"""
    SELECT peptide, {r("avg(heavy_area / nullif(heavy_background, 0)) AS heavy_snr",
                       "avg(light_area / nullif(light_background, 0)) AS light_snr")} FROM means GROUP BY peptide""")
oracle("to_concentration", "", f"""
    SELECT l_orderkey, l_partkey, {r("l_discount * p_size * 40 AS concentration_fm_ul",
           "l_discount * p_size * 40 * p_retailprice * 1e-6::DOUBLE AS concentration_ug_ml")}
    FROM lineitem JOIN part ON p_partkey = l_partkey""")
oracle("hyperbolic_threshold", "", f"""
    SELECT l_orderkey, l_partkey, {r(
        "CASE WHEN x = 1 THEN 'inf'::DOUBLE ELSE 0.5 / abs(x - 1) END - log10(0.05) AS threshold",
        "CASE WHEN abs(x) = 1 THEN 'inf'::DOUBLE ELSE 0.5 / abs(abs(x) - 1) END - log10(0.05) AS symmetric_threshold")}
    FROM (SELECT l_orderkey, l_partkey, log2(l_quantity) - l_linenumber::DOUBLE / 2 AS x FROM lineitem)""")
oracle("recode_labels", "", f"""
    SELECT c_custkey, segment, {big("CASE WHEN segment = 'FURNITURE' THEN 1 ELSE 0 END AS label")}
    FROM (SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'FURNITURE' ELSE c_mktsegment END AS segment
          FROM customer)""")
oracle("floor_zero", "", f"""
    SELECT l_orderkey, l_partkey, {r("CASE WHEN l_discount = 0 THEN 1 ELSE l_discount END AS floored")} FROM lineitem""")
oracle("logit_cutoff", "", f"""
    SELECT l_orderkey, l_partkey, {r("(ln(0.7::DOUBLE / 0.3) - l_quantity) / nullif(l_tax, 0) AS cutoff")} FROM lineitem""")

# Filters and joins

oracle("drop_botched_runs", "", f"""
    SELECT 'tables' AS "set", l_orderkey, {r("l_extendedprice")}, run
    FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN l_suppkey END AS run FROM lineitem)
    WHERE run IS NULL OR run NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 2000)""")
oracle("quantifier_only", "tidy", f"""
    SELECT peptide, count(*) AS n, {r("avg(heavy_area) AS heavy_area")} FROM tidy WHERE heavy_transition_rank = 1 GROUP BY peptide""")
view("gvalues", "citems", """
    SELECT p_brand AS peptide, l_extendedprice * l_quantity / 50 AS value, l_quantity, c_mktsegment AS segment,
           o_orderstatus AS status,
           CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'unknown' ELSE o_orderpriority END AS priority
    FROM citems""")
oracle("drop_unknown_group", "gvalues", f"""
    SELECT priority, peptide, {r("value")} FROM gvalues WHERE segment <> 'BUILDING' AND priority <> 'unknown'""")
oracle("category_limits", "", f"""
    SELECT c_custkey, c_mktsegment, {big("CASE c_mktsegment WHEN 'MACHINERY' THEN 1 ELSE 2 END AS category_order")}
    FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')""")
oracle("condition_subset", "", """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""")
oracle("above_lod", "conc", f"""
    SELECT {EXPERIMENT}, peptide, {r("concentration_ug_ml")} FROM conc WHERE concentration_ug_ml > lod""")
view("followed", "items", """
    SELECT o_custkey AS subject_id, p_brand AS peptide, year(o_orderdate)::BIGINT AS timepoint,
           avg(l_extendedprice) AS concentration_ug_ml
    FROM items GROUP BY ALL""")
view("followed_long", "followed", """
    SELECT * FROM followed WHERE subject_id IN (
        SELECT subject_id FROM followed GROUP BY subject_id
        HAVING count(*) > (SELECT count(DISTINCT peptide) FROM followed))""")
oracle("complete_subjects", "followed_long", f"""
    SELECT subject_id, peptide, timepoint, {r("concentration_ug_ml")} FROM followed_long""")
oracle("enrich_left", "", f"""
    SELECT listed AS l_partkey, l_orderkey, {r("l_extendedprice")}, p_brand, {r("p_retailprice")}
    FROM (SELECT *, CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END AS listed FROM lineitem) LEFT JOIN part ON p_partkey = listed""")
oracle("lookup_first", "", f"""
    SELECT c_custkey, {big("c_nationkey")}, s_name, {r("s_acctbal")}
    FROM customer LEFT JOIN (SELECT s_nationkey, arg_min(s_name, s_suppkey) AS s_name, arg_min(s_acctbal, s_suppkey) AS s_acctbal
                             FROM supplier GROUP BY s_nationkey) ON s_nationkey = c_nationkey""")
oracle("attach_group_stat", "", f"""
    SELECT l_returnflag, l_orderkey, l_partkey, {r("l_quantity", "stddev_samp(l_quantity) OVER (PARTITION BY l_returnflag) AS total_sd")}
    FROM lineitem""")

# Sets

oracle("distinct_first", "", f"""
    SELECT l_partkey, l_orderkey, {big("l_linenumber")}, l_suppkey, {r("l_extendedprice")}, l_returnflag FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey,
               l_quantity, l_extendedprice, l_discount, l_tax) AS place FROM lineitem) WHERE place = 1""")
oracle("distinct_values", "", "SELECT DISTINCT CASE WHEN l_tax > 0 THEN l_partkey END AS l_partkey FROM lineitem")
oracle("union_sets", "", f"""
    SELECT o_orderkey AS "key", {r("o_totalprice AS price")}, NULL::VARCHAR AS priority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT l_orderkey, {r("l_extendedprice AS price")}, NULL FROM lineitem""")
oracle("set_difference", "", """
    SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
oracle("train_test_split", "", f"""
    SELECT o_orderpriority, o_orderkey, {r("o_totalprice")},
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('1354|' || o_orderkey))
           <= round(0.3::DOUBLE * count(*) OVER (PARTITION BY o_orderpriority)) AS is_train
    FROM orders""")

# Replicates

oracle("replicate_means", "means", f"""
    SELECT {EXPERIMENT}, peptide, fragment_ion, {big("heavy_transition_rank")}, run, texlevel, {r(*AVERAGED)} FROM means""")
oracle("replicate_cv", "tidy", f"""
    SELECT subject_id, condition, timepoint, {r("any_value(curvepoint) AS curvepoint")}, peptide AS peptide_mods, fragment_ion,
           {", ".join(f"round(CASE WHEN count({c}) = count(*) THEN stddev_samp({c}) / nullif(avg({c}), 0) END, 6) + 0.0 AS {c}" for c in AVERAGED)}
    FROM tidy GROUP BY subject_id, condition, timepoint, curvepoint, peptide, fragment_ion""")


def cv(column: str) -> str:
    return f"stddev_samp({column}) / nullif(avg({column}), 0)"


def strict_cv(column: str) -> str:
    return f"CASE WHEN count({column}) = count(*) THEN {cv(column)} END"


def as_percent(share: str) -> str:
    return f"CASE WHEN {share} IS NOT NULL THEN printf('%.2f', round(100 * ({share}), 2)) || '%' END"


oracle("replicate_cv_percent", "tidy", f"""
    SELECT subject_id, condition, peptide AS peptide_mods, fragment_ion,
           {", ".join(f"{as_percent(c)} AS {c}" for c in AVERAGED)}
    FROM (SELECT subject_id, condition, peptide, fragment_ion, {", ".join(f"{strict_cv(c)} AS {c}" for c in AVERAGED)}
          FROM tidy GROUP BY subject_id, condition, timepoint, curvepoint, peptide, fragment_ion)""")
oracle("peptide_concentrations", "conc", f"""
    SELECT 'tables' AS "set", run, peptide, protein, stage_specificity, {EXPERIMENT}, histology, tese, texlevel,
           {r("rdotp", "concentration_fm_ul", "concentration_ug_ml", "lth", "heavy_background", "light_background",
              "heavy_max_height", "light_max_height", "fmol_ul", "loq_ug_ml", "lod", "lh_rt_diff", "heavy_snr",
              "light_snr", "molecular_weight",
              "CASE WHEN lh_rt_diff IS NULL THEN 1 ELSE lh_rt_diff / (SELECT max(lh_rt_diff) FROM conc) END AS lh_rt_diff_rel")}
    FROM conc""")


RETENTION = ["heavy_retention_time", "light_retention_time"]


def retention_report(missing: str) -> str:
    def kept(expression: str, *columns: str) -> str:
        whole = " AND ".join(f"count({c}) = count(*)" for c in columns)
        return expression if missing == "left out" else f"CASE WHEN {whole} THEN {expression} END"

    averages = ", ".join(
        f"{r(kept(f'avg({c})', c) + f' AS mean_{c}')}, {as_percent(kept(cv(c), c))} AS cv_{c}" for c in RETENTION
    )
    apart = kept(f"abs(avg({RETENTION[0]}) - avg({RETENTION[1]}))", *RETENTION)
    return f"""SELECT peptide || '_2+' AS precursor_name, any_value(protein) AS protein, peptide, {averages},
        {r(apart + " AS mean_lh_rt_diff")}, '{missing}' AS missing FROM tidy GROUP BY peptide"""


oracle("rt_report", "tidy", retention_report("strict") + " UNION ALL " + retention_report("left out"))
oracle("rt_report_narm", "tidy", f"""
    SELECT peptide || '_2+' AS precursor_name, any_value(protein) AS protein, peptide,
           {r("avg(heavy_retention_time) AS mean_heavy_retention_time", cv("heavy_retention_time") + " AS cv_heavy_retention_time",
              "avg(light_retention_time) AS mean_light_retention_time", cv("light_retention_time") + " AS cv_light_retention_time",
              "abs(avg(heavy_retention_time) - avg(light_retention_time)) AS mean_lh_rt_diff")}
    FROM tidy GROUP BY peptide""")
oracle("relative_to_max", "", f"""
    SELECT l_orderkey, l_partkey, {r("shift", "l_quantity", "CASE WHEN shift IS NULL THEN 1::DOUBLE END AS shift_rel",
           "coalesce(shift / max(shift) OVER (), 1) AS shift_rel_na_rm", "l_quantity / max(l_quantity) OVER () AS quantity_rel")}
    FROM (SELECT l_orderkey, l_partkey, nullif(l_tax, 0.02) AS shift, l_quantity FROM lineitem)""")
oracle("sort_by_concentration", "conc", f"""
    SELECT peptide, subject_id, condition, {r("concentration_ug_ml")} FROM conc""")

# Calibration

view("creps", "items amounts info", """
    SELECT g.*, 1 / nullif(lth, 0) AS htl, fmol_ul * curvepoint AS theor_h_fm_ul, fmol_ul / nullif(lth, 0) AS h_concentration_fm_ul,
           fmol_ul * curvepoint * mw * 1e-6 AS theor_h_ug_ml, fmol_ul / nullif(lth, 0) * mw * 1e-6 AS h_concentration_ug_ml,
           protein, mw, stage_specificity
    FROM (SELECT l_linenumber::DOUBLE AS curvepoint, p_brand AS peptide, o_orderpriority AS trial,
                 avg(fmol_ug * 40) AS fmol_ul, avg(1 - l_discount) AS rdotp, avg(l_discount) AS lth
          FROM items JOIN amounts ON amounts.peptide = p_brand
          GROUP BY ALL) g LEFT JOIN info USING (peptide)""")
view("cpoints", "creps", """
    SELECT *, cv_htl < 0.06 AS sdthr FROM (
        SELECT curvepoint, peptide, avg(htl) AS mean_htl, stddev_samp(htl) AS sd_htl,
               stddev_samp(htl) / nullif(avg(htl), 0) AS cv_htl, avg(theor_h_ug_ml) AS theor_h_ug_ml,
               any_value(protein) AS protein, any_value(stage_specificity) AS stage_specificity
        FROM creps GROUP BY curvepoint, peptide)""")
view("crange", "cpoints", """
    SELECT *, linthr AND sdthr AS cthr FROM (
        SELECT c.* REPLACE (CASE WHEN worst IS NULL THEN NULL WHEN curvepoint <= worst THEN FALSE ELSE sdthr END AS sdthr),
               curvepoint >= 2 AS linthr
        FROM (SELECT *, CASE WHEN count(sdthr) OVER w = count(*) OVER w
                             THEN max(CASE WHEN sdthr THEN 0 ELSE curvepoint END) OVER w END AS worst
              FROM cpoints WINDOW w AS (PARTITION BY peptide)) c)""")
POINT = "peptide, protein, stage_specificity, " + r("curvepoint", "mean_htl", "sd_htl", "cv_htl", "theor_h_ug_ml") + ", sdthr"
oracle("curve_replicates", "creps", f"""
    SELECT peptide, trial, protein, stage_specificity, {r("curvepoint", "fmol_ul", "rdotp", "lth", "htl", "theor_h_fm_ul",
           "h_concentration_fm_ul", "mw", "theor_h_ug_ml", "h_concentration_ug_ml")} FROM creps""")
oracle("curve_points", "cpoints", f"SELECT {POINT} FROM cpoints")
oracle("linear_range", "crange", f"SELECT {POINT}, linthr, cthr FROM crange")
oracle("limit_of_quantification", "crange", f"""
    SELECT protein, peptide, stage_specificity, {r("min(curvepoint) AS loq_point", "min(theor_h_ug_ml) AS loq_ug_ml")}
    FROM crange WHERE cthr GROUP BY protein, peptide, stage_specificity""")


def fit(keys: str, x: str, y: str, source: str) -> str:
    return f"""
    SELECT {keys}, n, {r("slope", "intercept", "r2", "1 - (1 - r2) * (n - 1) / nullif(n - 2, 0) AS adj_r2")} FROM (
        SELECT {keys}, count(*) AS n, covar_pop({y}, {x}) / nullif(var_pop({x}), 0) AS slope,
               avg({y}) - covar_pop({y}, {x}) / nullif(var_pop({x}), 0) * avg({x}) AS intercept,
               covar_pop({y}, {x}) ** 2 / nullif(var_pop({x}) * var_pop({y}), 0) AS r2
        FROM {source} GROUP BY {keys})"""


view("clogs", "crange", """
    SELECT peptide, cthr, log10(theor_h_ug_ml) AS x, log10(mean_htl) AS y FROM crange WHERE theor_h_ug_ml > 0 AND mean_htl > 0""")
oracle("calibration_fit", "crange", fit(
    "peptide", "theor_h_ug_ml", "mean_htl", "(SELECT * FROM crange WHERE sdthr AND mean_htl IS NOT NULL)"))
oracle("calibration_fit_log", "clogs", fit("peptide, cthr", "x", "y", "clogs"))
oracle("optimal_spike", "tidy", f"""
    SELECT any_value(protein) AS protein, peptide, {r("avg(fmol_ug) AS fmol_ug", "avg(fmol_ul) AS fmol_ul",
           "avg(lth) AS mean_lth", cv("lth") + " AS cv_lth", "round(avg(fmol_ug) * avg(lth) * 3, 2) AS opt_fmol_ug")}
    FROM tidy WHERE curvepoint = 1 GROUP BY peptide""")

SIX = [f"{i}_{m}" for i in ("heavy", "light") for m in MEASURES if m != "max_height"]
oracle("tidy_calibration", "tidy", f"""
    SELECT replicate_name || '_' || peptide || '_2+-->' || fragment_ion || '_1+' AS transition_id,
           subject_id || ' ' || condition AS experiment_id,
           curvepoint::BIGINT || ' ' || peptide || '_2+-->' || fragment_ion || '_1+' AS experiment_transition_id,
           protein, {r("fmol_ug", "fmol_ul", "rdotp",
                       "CASE WHEN fragment_ion = 'R' OR lth = 0 THEN light_area / nullif(heavy_area, 0) ELSE lth END AS lth",
                       *[c for c in SIX if "rank" not in c])}, {big("heavy_transition_rank", "light_transition_rank")}
    FROM tidy""")
PLAIN = [f"{i}_{m}" for m in ("retention_time", "area", "background", "transition_rank") for i in ("heavy", "light")] + ["rdotp"]
RATIOS = {"lh": ("lth", "alh"), "hl": ("hl", "ahl")}
oracle("curve_transition_summary", "tidy", f"""
    SELECT {r("curvepoint")}, protein, peptide, transition_name, {r("fmol_ul", "fmol_ug", *[f"{s}_{c}" for c in PLAIN for s in ("mean", "cv")],
        "CASE WHEN mean_lth = 0 THEN mean_alh ELSE mean_lth END AS mean_light_to_heavy",
        "CASE WHEN mean_lth = 0 THEN cv_alh ELSE cv_lth END AS cv_light_to_heavy",
        "CASE WHEN mean_lth = 0 THEN mean_ahl ELSE mean_hl END AS mean_heavy_to_light",
        "CASE WHEN mean_lth = 0 THEN cv_ahl ELSE cv_hl END AS cv_heavy_to_light", nudge=1e-9)}
    FROM (SELECT curvepoint, any_value(protein) AS protein, peptide, peptide || '_2+-->' || fragment_ion || '_1+' AS transition_name,
                 any_value(fmol_ul) AS fmol_ul, any_value(fmol_ug) AS fmol_ug,
                 {", ".join(f"CASE WHEN count({c}) = count(*) THEN avg({c}) END AS mean_{c}, {strict_cv(c)} AS cv_{c}" for c in PLAIN)},
                 {", ".join(f"CASE WHEN count({c}) = count(*) THEN avg({c}) END AS mean_{c}, CASE WHEN count({c}) = count(*) THEN {cv(c)} END AS cv_{c}"
                            for c in ("lth", "hl", "alh", "ahl"))}
          FROM (SELECT * REPLACE (CASE WHEN fragment_ion = 'R' THEN 0 ELSE lth END AS lth),
                       CASE WHEN fragment_ion <> 'R' THEN 1 / nullif(lth, 0) END AS hl,
                       light_area / nullif(heavy_area, 0) AS alh, heavy_area / nullif(light_area, 0) AS ahl FROM tidy)
          GROUP BY curvepoint, peptide, fragment_ion)""")
oracle("curve_frame", "clogs", f"""
    SELECT c.peptide, {r("curvepoint", "theor_h_ug_ml", "mean_htl", "mean_htl - sd_htl AS lower", "mean_htl + sd_htl AS upper")}, c.cthr,
           {r("slope AS line_slope", "my - slope * mx AS line_intercept")}
    FROM crange c LEFT JOIN (SELECT peptide, cthr, covar_pop(y, x) / nullif(var_pop(x), 0) AS slope, avg(y) AS my, avg(x) AS mx
                             FROM clogs GROUP BY peptide, cthr) f
    ON f.peptide = c.peptide AND f.cthr IS NOT DISTINCT FROM c.cthr""")

# Longitudinal

view("longit", "followed_long", """
    SELECT *, concentration_ug_ml / min(concentration_ug_ml) OVER (PARTITION BY subject_id, peptide) AS concentration_r,
           stddev_samp(concentration_ug_ml) OVER (PARTITION BY peptide) AS total_sd,
           stddev_samp(concentration_ug_ml) OVER (PARTITION BY subject_id, peptide) AS group_sd
    FROM (SELECT * REPLACE (CASE WHEN concentration_ug_ml = 0 THEN 1 ELSE concentration_ug_ml END AS concentration_ug_ml) FROM followed_long)""")
oracle("ratio_to_group_min", "followed", f"""
    SELECT subject_id, peptide, timepoint, {r("concentration_ug_ml",
           "concentration_ug_ml / min(concentration_ug_ml) OVER (PARTITION BY subject_id, peptide) AS concentration_r")} FROM followed""")
oracle("sd_ratio", "longit", f"""
    SELECT subject_id, peptide, {r("any_value(group_sd) AS group_sd", "any_value(total_sd) AS total_sd",
           "any_value(group_sd) / nullif(any_value(total_sd), 0) AS sdr")} FROM longit GROUP BY subject_id, peptide""")
oracle("mean_sd_ratio", "longit", f"""
    SELECT peptide, {r("avg(sdr) AS mean_sdr")} FROM (
        SELECT subject_id, peptide, any_value(group_sd) / nullif(any_value(total_sd), 0) AS sdr FROM longit GROUP BY subject_id, peptide)
    GROUP BY peptide""")
oracle("timepoint_frame", "longit", f"SELECT subject_id, peptide, timepoint, {r('concentration_r')} FROM longit")
oracle("rank_avg", "", f"""
    SELECT l_returnflag, l_orderkey, l_partkey, {r("l_quantity",
           "rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS rank")}
    FROM lineitem""")
oracle("rank_sum", "citems", f"""
    SELECT c_nationkey::BIGINT AS c_nationkey, {r("rank_sum")}, CASE WHEN rank_sum IS NOT NULL THEN dense_rank() OVER (ORDER BY rank_sum NULLS LAST) END AS place
    FROM (SELECT c_nationkey, CASE WHEN count(*) = (SELECT count(DISTINCT p_brand) FROM citems) THEN sum(place) END AS rank_sum
          FROM (SELECT c_nationkey, p_brand, rank() OVER (PARTITION BY p_brand ORDER BY amount DESC)
                       + (count(*) OVER (PARTITION BY p_brand, amount) - 1) / 2.0::DOUBLE AS place
                FROM (SELECT c_nationkey, p_brand, sum(l_quantity::BIGINT) AS amount FROM citems GROUP BY ALL))
          GROUP BY c_nationkey)""")


# Probabilities in SQL

def normal_sf(x: str) -> str:
    """Upper normal tail of x >= 0 by Simpson's rule."""
    weight = "(CASE WHEN i IN (0, 400) THEN 1.0::DOUBLE WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    total = f"list_sum(list_transform(range(0, 401), lambda i: {weight} * exp(-pow(({x}) * i / 400.0::DOUBLE, 2) / 2)))"
    return f"(0.5 - ({x}) / 1200.0::DOUBLE * {total} / sqrt(2 * pi()))"


def t_sf(t: str, df: str) -> str:
    """Upper t tail: Simpson's rule over the angle atan(t / sqrt(df))."""
    weight = "(CASE WHEN i IN (0, 1000) THEN 1.0::DOUBLE WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"

    def area(angle: str) -> str:
        return (f"(({angle}) / 3000.0::DOUBLE * list_sum(list_transform(range(0, 1001), "
                f"lambda i: {weight} * pow(greatest(cos(({angle}) * i / 1000.0::DOUBLE), 0), ({df}) - 1))))")

    whole = area("pi() / 2")
    return f"(0.5 - 0.5 * {area(f'atan(({t}) / sqrt({df}))')} / {whole})"


def phi_fast(x: str) -> str:
    """Normal distribution by the published rational-exponential erfc fit, good to 1e-7."""
    t = f"(1 / (1 + 0.5 * abs({x}) / sqrt(2.0::DOUBLE)))"
    coefficients = (
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
        -0.82215223, 0.17087277,
    )
    series = f"{coefficients[-1]}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        series = f"({c}::DOUBLE + {t} * {series})"
    tail = f"0.5 * {t} * exp(-({x}) * ({x}) / 2 + {series})"
    return f"(CASE WHEN {x} >= 0 THEN 1 - {tail} ELSE {tail} END)"


def f_tail(f: str, df1: str, df2: str) -> str:
    """Closed forms for 2 and 4 numerator degrees of freedom."""
    x = f"({df2} / ({df2} + {df1} * {f}))"
    return (f"CASE {df1} WHEN 2 THEN pow({x}, {df2} / 2) "
            f"WHEN 4 THEN pow({x}, {df2} / 2) * (1 + {df2} / 2 * (1 - {x})) END")


def group_tests(source: str, prefix: str, alpha: float | None = None) -> None:
    """Views of both test families over ``source (analyte, grp, v)``."""
    p = prefix
    view(f"{p}gs", source, f"""
        SELECT analyte, grp, count(*)::DOUBLE AS n, avg(v) AS m, var_pop(v) * count(*) AS ss FROM {source} GROUP BY analyte, grp""")
    view(f"{p}g0", f"{p}gs", f"""
        SELECT analyte, count(*)::DOUBLE AS k, sum(n) AS nn, sum(n * m) / sum(n) AS gm, count(*) / sum(1 / n) AS nh, sum(ss) AS ssw
        FROM {p}gs GROUP BY analyte""")
    view(f"{p}anova", f"{p}g0", f"""
        SELECT *, {f_tail("f", "df1", "df2")} AS p FROM (
            SELECT analyte, k, nn, nh, k - 1 AS df1, nn - k AS df2, ssw / (nn - k) AS mse,
                   sum(n * (m - gm) ** 2) / (k - 1) / (ssw / (nn - k)) AS f
            FROM {p}gs JOIN {p}g0 USING (analyte) GROUP BY analyte, k, nn, nh, ssw)""")
    passed = f"WHERE p < {alpha}" if alpha else ""
    view(f"{p}placed", f"{p}anova", f"""
        SELECT g.*, k, df2, mse, nh, row_number() OVER (PARTITION BY analyte ORDER BY m DESC, grp) AS place
        FROM {p}gs g JOIN (SELECT * FROM {p}anova {passed}) USING (analyte)""")
    view(f"{p}pairs", f"{p}placed", f"""
        SELECT a.analyte, a.grp AS g1, b.grp AS g2, b.m - a.m AS diff, a.k, a.df2, abs(a.place - b.place) + 1 AS span,
               abs(b.m - a.m) / sqrt(a.mse / 2 * (1 / a.n + 1 / b.n)) AS tq, abs(b.m - a.m) / sqrt(a.mse / a.nh) AS dq
        FROM {p}placed a JOIN {p}placed b ON a.analyte = b.analyte AND a.grp < b.grp""")
    view(f"{p}zgrid", "", f"""
        SELECT z, w, {phi_fast("z")} AS cdf FROM (
            SELECT -8 + j / 10.0::DOUBLE AS z,
                   (CASE WHEN j IN (0, 160) THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END) / 30.0::DOUBLE
                   * exp(-pow(-8 + j / 10.0::DOUBLE, 2) / 2) / sqrt(2 * pi()) AS w
            FROM range(161) t(j))""")
    view(f"{p}sgrid", f"{p}pairs", f"""
        SELECT df2, s, w * exp(ln(2) + df2 / 2 * ln(df2 / 2) - lgamma(df2 / 2) + (df2 - 1) * ln(s) - df2 * s * s / 2) AS w FROM (
            SELECT df2, 1 + (j - 32) / 4.0::DOUBLE / sqrt(2 * df2) AS s,
                   (CASE WHEN j IN (0, 64) THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END) / 12.0::DOUBLE / sqrt(2 * df2) AS w
            FROM (SELECT DISTINCT df2 FROM {p}pairs), range(65) t(j))""")

    def tail(q: str, k: str) -> str:
        shifted = f"(z.z - {q} * s.s)"
        return f"1 - sum(s.w * {k} * z.w * pow(greatest(z.cdf - {phi_fast(shifted)}, 0), {k} - 1))"

    view(f"{p}tukey", f"{p}pairs {p}zgrid {p}sgrid", f"""
        SELECT analyte, g1, g2, diff, tq AS q, greatest({tail("tq", "k")}, 0) AS p
        FROM {p}pairs JOIN {p}sgrid s USING (df2), {p}zgrid z GROUP BY analyte, g1, g2, diff, tq""")
    view(f"{p}duncan", f"{p}pairs {p}zgrid {p}sgrid", f"""
        SELECT analyte, g1, g2, diff, span, dq AS q, round(1 - pow(1 - greatest({tail("dq", "span")}, 0), 1.0::DOUBLE / (span - 1)), 4) AS p
        FROM {p}pairs JOIN {p}sgrid s USING (df2), {p}zgrid z GROUP BY analyte, g1, g2, diff, span, dq""")


def rank_tests(source: str, prefix: str, alpha: float | None = None) -> None:
    p = prefix
    view(f"{p}rs", source, f"""
        SELECT analyte, grp, count(*)::DOUBLE AS n, sum(rk) AS rsum, sum(t * t - 1) AS ties FROM (
            SELECT analyte, grp, (count(*) OVER (PARTITION BY analyte, v))::DOUBLE AS t,
                   rank() OVER (PARTITION BY analyte ORDER BY v) + (count(*) OVER (PARTITION BY analyte, v) - 1) / 2.0::DOUBLE AS rk
            FROM {source}) GROUP BY analyte, grp""")
    view(f"{p}kruskal", f"{p}rs", f"""
        SELECT *, CASE df WHEN 2 THEN exp(-h / 2) WHEN 4 THEN exp(-h / 2) * (1 + h / 2) END AS p FROM (
            SELECT analyte, count(*) AS k, sum(n) AS nn, sum(ties) AS ties, count(*) - 1 AS df,
                   (12 / (sum(n) * (sum(n) + 1)) * sum(rsum * rsum / n) - 3 * (sum(n) + 1))
                   / (1 - sum(ties) / (sum(n) ** 3 - sum(n))) AS h
            FROM {p}rs GROUP BY analyte)""")
    passed = f"WHERE p < {alpha}" if alpha else ""
    view(f"{p}z", f"{p}kruskal", f"""
        SELECT a.analyte, a.grp AS g1, b.grp AS g2, (a.rsum / a.n - b.rsum / b.n)
               / sqrt((nn * (nn + 1) / 12 - t.ties / (12 * (nn - 1))) * (1 / a.n + 1 / b.n)) AS z
        FROM {p}rs a JOIN {p}rs b ON a.analyte = b.analyte AND a.grp < b.grp
        JOIN (SELECT * FROM {p}kruskal {passed}) t ON t.analyte = a.analyte""")
    view(f"{p}dp", f"{p}z", f"SELECT *, {normal_sf('abs(z)')} AS p FROM {p}z")
    view(f"{p}dunn", f"{p}dp", bh(f"{p}dp", "p", "p_adjusted", "analyte"))


def bh(source: str, p: str, out: str, family: str | None = None) -> str:
    part = f"PARTITION BY {family}" if family else ""
    return f"""
        SELECT * EXCLUDE (_raw), CASE WHEN {p} IS NOT NULL THEN least(1, min(_raw) OVER ({part} ORDER BY {p} DESC)) END AS {out} FROM (
            SELECT *, {p} * count({p}) OVER ({part}) / row_number() OVER ({part} ORDER BY {p}) AS _raw FROM {source})"""


for label, column, value in (("seg", "segment", "value"), ("sta", "status", "value"), ("qseg", "segment", "l_quantity"),
                             ("qsta", "status", "l_quantity")):
    view(f"{label}_obs", "gvalues", f"SELECT peptide AS analyte, {column} AS grp, {value} AS v FROM gvalues")
group_tests("seg_obs", "seg_")
group_tests("sta_obs", "sta_")
group_tests("sta_obs", "stap_", 0.5)
rank_tests("qseg_obs", "qseg_")
rank_tests("qsta_obs", "qsta_")
rank_tests("qseg_obs", "qsegp_", 0.5)

oracle("group_counts", "gvalues", "SELECT peptide, segment, count(*) AS n FROM gvalues GROUP BY peptide, segment")
oracle("anova_oneway", "seg_anova", f"""
    SELECT analyte AS peptide, {big("k", "nn AS n", "df1", "df2")}, {r("f", "p")}, {r("mse AS ms_error", digits=3)} FROM seg_anova""")
# The 95 % point of the studentized range by Newton steps. The normal distribution comes from a table in steps of 1/200, summed up by
# Simpson's rule, and three terms of its Taylor series; the scale is averaged as above.
view("bells", "", """
    SELECT j, z, d, (CASE WHEN j < 0 THEN 0.5 - half ELSE 0.5 + half END) AS cdf FROM (
        SELECT k * side AS j, k * side / 200.0::DOUBLE AS z, exp(-pow(k / 200.0::DOUBLE, 2) / 2) / sqrt(2 * pi()) AS d,
               sum(slice) OVER (PARTITION BY side ORDER BY k) AS half
        FROM (SELECT k, CASE WHEN k = 0 THEN 0 ELSE (exp(-pow((k - 1) / 200.0::DOUBLE, 2) / 2) + 4 * exp(-pow((k - 0.5::DOUBLE) / 200, 2) / 2)
                     + exp(-pow(k / 200.0::DOUBLE, 2) / 2)) / 1200 / sqrt(2 * pi()) END AS slice FROM range(1801) t(k)), (VALUES (1), (-1)) u(side))""")
view("bell", "bells", "SELECT j, any_value(z) AS z, any_value(d) AS d, any_value(cdf) AS cdf FROM bells GROUP BY j")
view("range0", "sta_anova", "SELECT DISTINCT df2, k, 3.3::DOUBLE AS q FROM sta_anova")
view("bell_nodes", "bell", """
    SELECT z, cdf, (CASE WHEN abs(j) = 1600 THEN 1 WHEN (j // 20) % 2 = 0 THEN 2 ELSE 4 END) / 30.0::DOUBLE * d AS w
    FROM bell WHERE j % 20 = 0 AND abs(j) <= 1600""")
for step in range(1, 4):
    off = "(shifted - p.z)"
    below = f"(CASE WHEN abs(shifted) > 8.99 THEN (shifted > 0)::INT ELSE p.cdf + d * ({off} - p.z * pow({off}, 2) / 2 + (p.z * p.z - 1) * pow({off}, 3) / 6) END)"
    view(f"nodes{step}", f"range{step - 1} sta_sgrid bell_nodes", f"""
        SELECT q.df2, k, q, s, z.z - q * s AS shifted, z.cdf AS top, s.w * z.w AS w,
               greatest(least(round((z.z - q * s) * 200), 1800), -1800)::BIGINT AS j
        FROM range{step - 1} q JOIN sta_sgrid s USING (df2), bell_nodes z""")
    view(f"range{step}", f"nodes{step} bell", f"""
        SELECT df2, k, q - (1 - inside - 0.05) / -slope AS q FROM (
            SELECT df2, k, q, sum(w * pow(gap, k - 1)) * k AS inside,
                   sum(w * pow(gap, k - 2) * exp(-shifted * shifted / 2) / sqrt(2 * pi()) * s) * k * (k - 1) AS slope
            FROM (SELECT df2, k, q, s, w, shifted, greatest(top - {below}, 0) AS gap FROM nodes{step} JOIN bell p USING (j))
            GROUP BY df2, k, q)""")
oracle("tukey_hsd", "sta_tukey range3", f"""
    SELECT analyte AS peptide, g1 AS group1, g2 AS group2, {r("diff", "t.q AS q")}, {r("t.p AS p", digits=4)},
           {r("diff - w.q * abs(diff) / t.q AS lower", "diff + w.q * abs(diff) / t.q AS upper", digits=3)}
    FROM sta_tukey t JOIN sta_anova USING (analyte) JOIN range3 w USING (df2)""")
oracle("duncan_mrt", "seg_duncan", f"""
    SELECT analyte AS peptide, g1 AS group1, g2 AS group2, {r("diff", "q", "p")}, {big("span")} FROM seg_duncan""")
oracle("anova_posthoc", "stap_tukey stap_duncan", f"""
    SELECT analyte AS peptide, 'anova' AS test, NULL::VARCHAR AS group1, NULL::VARCHAR AS group2, {r("f AS statistic")}, {r("p", digits=4)}
    FROM stap_anova WHERE p < 0.5
    UNION ALL SELECT analyte, 'tukey', g1, g2, {r("q AS statistic")}, {r("p", digits=4)} FROM stap_tukey WHERE p <= 0.5
    UNION ALL SELECT analyte, 'duncan', g1, g2, {r("q AS statistic")}, {r("p", digits=4)} FROM stap_duncan WHERE p <= 0.5""")
oracle("kruskal_wallis", "qseg_kruskal", f"""
    SELECT analyte AS peptide, k, {big("nn AS n")}, df, {r("h", "p")} FROM qseg_kruskal""")
oracle("dunn_test", "qsta_dunn", f"""
    SELECT analyte AS peptide, g1 AS group1, g2 AS group2, {r("z", "p", "p_adjusted")} FROM qsta_dunn""")
oracle("kruskal_dunn", "qsegp_dunn", f"""
    SELECT analyte AS peptide, 'kruskal' AS test, NULL::VARCHAR AS group1, NULL::VARCHAR AS group2, {r("h AS statistic", "p")}
    FROM qsegp_kruskal WHERE p < 0.5
    UNION ALL SELECT analyte, 'dunn', g1, g2, {r("z AS statistic", "p_adjusted AS p")} FROM qsegp_dunn WHERE p_adjusted <= 0.5""")

view("factor_obs", "gvalues", """
    SELECT factor || '|' || peptide AS analyte, level AS grp, value AS v FROM (
        SELECT 'segment' AS factor, peptide, segment AS level, value FROM gvalues
        UNION ALL SELECT 'status', peptide, status, value FROM gvalues
        UNION ALL SELECT 'priority', peptide, priority, value FROM gvalues) WHERE level <> 'unknown'""")
group_tests("factor_obs", "fa_", 0.5)
rank_tests("factor_obs", "fa_k", 0.5)
FACTOR_KEY = "split_part(analyte, '|', 1) AS factor, split_part(analyte, '|', 2) AS peptide"
oracle("group_tests_by_factor", "fa_tukey fa_duncan fa_kdunn", f"""
    SELECT {FACTOR_KEY}, 'anova' AS test, NULL::VARCHAR AS group1, NULL::VARCHAR AS group2, {r("f AS statistic")}, {r("p", digits=4)} FROM fa_anova WHERE p < 0.5
    UNION ALL SELECT {FACTOR_KEY}, 'kruskal', NULL, NULL, {r("h AS statistic")}, {r("p", digits=4)} FROM fa_kkruskal WHERE p < 0.5
    UNION ALL SELECT {FACTOR_KEY}, 'tukey', g1, g2, {r("q AS statistic")}, {r("p", digits=4)} FROM fa_tukey WHERE p <= 0.5
    UNION ALL SELECT {FACTOR_KEY}, 'duncan', g1, g2, {r("q AS statistic")}, {r("p", digits=4)} FROM fa_duncan WHERE p <= 0.5
    UNION ALL SELECT {FACTOR_KEY}, 'dunn', g1, g2, {r("z AS statistic")}, {r("p_adjusted AS p", digits=4)} FROM fa_kdunn WHERE p_adjusted <= 0.5""")

view("part_p", "", "SELECT p_partkey, p_brand, p_size / 60.0::DOUBLE AS p FROM part")
view("part_bh", "part_p", bh("part_p", "p", "p_brand_bh", "p_brand"))
view("part_bh2", "part_bh", bh("part_bh", "p", "p_bh"))
oracle("p_adjust_bh", "part_bh2", f"SELECT p_partkey, p_brand, {r('p', 'p_brand_bh', 'p_bh')} FROM part_bh2")

# Paired tests

for name, subject in (("wide", "c_nationkey"), ("cwide", "o_custkey")):
    view(name, "citems", f"""
        SELECT *, pre / nullif(post, 0) AS fc FROM (
            SELECT {subject}::BIGINT AS subject_id, p_brand AS peptide, avg(l_extendedprice) FILTER (l_linestatus = 'F') AS pre,
                   avg(l_extendedprice) FILTER (l_linestatus = 'O') AS post
            FROM citems GROUP BY ALL)""")
view("psum", "wide", f"""
    SELECT *, sqrt((sd_pre ** 2 + sd_post ** 2) / 2) AS sd_pooled, sd_pre / sqrt(n) AS se_pre, sd_post / sqrt(n) AS se_post,
           sd_pre / n AS se_ref_pre, sd_post / n AS se_ref_post, log2(mean_fc) AS log2_fc
    FROM (SELECT peptide, count(*) AS n, {strict("avg", "pre", "mean_pre")}, {strict("avg", "post", "mean_post")},
                 {strict("stddev_samp", "pre", "sd_pre")}, {strict("stddev_samp", "post", "sd_post")}, {strict("avg", "fc", "mean_fc")}
          FROM wide GROUP BY peptide)""")
SUMMARY = [
    "mean_pre", "mean_post", "sd_pre", "sd_post", "mean_fc", "sd_pooled", "se_pre", "se_post", "se_ref_pre", "se_ref_post", "log2_fc",
]
view("ptest", "wide", f"""
    SELECT *, {t_sf("t", "df")} AS p, t / sqrt(n) AS cohen_d FROM (
        SELECT peptide, count(*) AS n, count(pre - post) AS pairs, count(pre - post) - 1 AS df,
               avg(pre - post) / (stddev_samp(pre - post) / sqrt(count(pre - post))) AS t
        FROM wide GROUP BY peptide)""")


def signed_ranks(wide: str) -> str:
    return f"""
        SELECT *, n < 50 AND ties = 0 AND zeros = 0 AS exact FROM (
            SELECT peptide, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS v, count(*) AS n, sum(t * t - 1) AS ties, any_value(zeros) AS zeros FROM (
                SELECT peptide, d, zeros, (count(*) OVER (PARTITION BY peptide, abs(d)))::DOUBLE AS t,
                       rank() OVER (PARTITION BY peptide ORDER BY abs(d)) + (count(*) OVER (PARTITION BY peptide, abs(d)) - 1) / 2.0::DOUBLE AS rk
                FROM (SELECT peptide, pre - post AS d, count(*) FILTER (pre = post) OVER (PARTITION BY peptide) AS zeros
                      FROM {wide} WHERE pre IS NOT NULL AND post IS NOT NULL) WHERE d <> 0)
            GROUP BY peptide)"""


view("srank", "wide", signed_ranks("wide"))
view("csrank", "cwide", signed_ranks("cwide"))
# Number of sign patterns of ranks 1..k per positive-rank sum.
view("patterns", "", """
    SELECT 0 AS k, 0 AS s, 1.0::DOUBLE AS ways
    UNION ALL
    SELECT k + 1, s + up * (k + 1), sum(ways) / 2 FROM patterns, (VALUES (0), (1)) u(up) WHERE k < 49 GROUP BY ALL""")
view("utest", "srank patterns", f"""
    SELECT peptide, n, zeros, v, exact, CASE WHEN exact THEN least(1, 2 * CASE WHEN v > n * (n + 1) / 4.0
               THEN (SELECT sum(ways) FROM patterns WHERE k = n AND s >= v) ELSE (SELECT sum(ways) FROM patterns WHERE k = n AND s <= v) END)
           ELSE 2 * {normal_sf("greatest(abs(v - n * (n + 1) / 4.0::DOUBLE) - 0.5, 0) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0::DOUBLE - ties / 48)")} END AS p
    FROM srank""")
oracle("paired_wide", "cwide info", f"""
    SELECT protein, stage_specificity, subject_id, peptide, {r("pre", "post", "fc")} FROM cwide LEFT JOIN info USING (peptide)""")
oracle("paired_summary", "psum", f"SELECT peptide, n, {r(*SUMMARY)} FROM psum")
oracle("paired_t", "ptest", f"SELECT peptide, pairs, df, {r('t', 'p', 'cohen_d')} FROM ptest")
oracle("wilcoxon_signed_rank", "utest", f"SELECT peptide, n, zeros, {r('v', 'p')}, exact FROM utest")
oracle("wilcoxon_normal", "csrank", f"""
    SELECT peptide, n, zeros, {r("v", "2 * " + normal_sf("greatest(abs(v - n * (n + 1) / 4.0::DOUBLE) - 0.5, 0) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0::DOUBLE - ties / 48)") + " AS p")},
           exact FROM csrank""")
# Power: the upper alpha/2 t quantile by bisection on the tail, then the noncentral t by Simpson's rule.
view("tcrit", "ptest", f"""
    SELECT df, 0 AS step, 0.0::DOUBLE AS lo, 50.0::DOUBLE AS hi FROM (SELECT DISTINCT n - 1 AS df FROM ptest)
    UNION ALL
    SELECT df, step + 1, CASE WHEN {t_sf("(lo + hi) / 2", "df")} > 0.25 THEN (lo + hi) / 2 ELSE lo END,
           CASE WHEN {t_sf("(lo + hi) / 2", "df")} > 0.25 THEN hi ELSE (lo + hi) / 2 END
    FROM tcrit WHERE step < 50""")
view("power", "tcrit", f"""
    SELECT peptide, sum(w * exp(ln(2) + df / 2 * ln(df / 2) - lgamma(df / 2) + (df - 1) * ln(s) - df * s * s / 2)
               * ({phi_fast("(shift - crit * s)")} + {phi_fast("(-shift - crit * s)")})) AS power
    FROM (SELECT peptide, c.df::DOUBLE AS df, abs(cohen_d) * sqrt(n) AS shift, (lo + hi) / 2 AS crit,
                 1 + (j - 100) / 100.0::DOUBLE * least(8 / sqrt(2 * c.df::DOUBLE), 0.999999) AS s,
                 (CASE WHEN j IN (0, 200) THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END) / 300.0::DOUBLE * least(8 / sqrt(2 * c.df::DOUBLE), 0.999999) AS w
          FROM ptest t JOIN tcrit c ON c.df = t.n - 1 AND step = 50, range(201) g(j))
    GROUP BY peptide""")
view("bio0", "psum ptest utest", """
    SELECT s.*, t.t, t.p AS p_t, t.cohen_d, u.v, u.p AS p_u FROM psum s JOIN ptest t USING (peptide) JOIN utest u USING (peptide)""")
view("bio1", "bio0", bh("bio0", "p_t", "p_bh"))
view("bio2", "bio1", bh("bio1", "p_u", "p_u_bh"))


def flag(p: str) -> str:
    return f"(abs(log2_fc) > 0.01 AND -log10({p}) > 0.5 / abs(log2_fc - 0.01) - log10(0.5))"


oracle("paired_biomarker_table", "bio2 power info", f"""
    SELECT protein, stage_specificity, peptide, n, {r(*SUMMARY, "t", "p_t", "p_bh", "cohen_d", "v", "p_u", "p_u_bh")}, {r("power", digits=4)},
           {flag("p_t")} AS flag_t, {flag("p_bh")} AS flag_bh, {flag("p_u_bh")} AS flag_u_bh
    FROM bio2 JOIN power USING (peptide) LEFT JOIN info USING (peptide)""")
# Sizes near that of the normal approximation, each with its own t quantile and power; power grows with the size.
view("sizes", "ptest", """
    SELECT peptide, cohen_d, n0 + j AS n, n0 + j - 1 AS df FROM (
        SELECT peptide, cohen_d, ceil(pow((1.959963984540054 + 0.8416212335729143) / cohen_d, 2))::BIGINT AS n0 FROM ptest), range(-3, 8) t(j)
    WHERE n0 + j >= 2""")
# Beyond 20,000 degrees of freedom the quantile is the normal one with the first term of its expansion.
view("size_crit", "sizes", f"""
    SELECT df, 0 AS step, 0.0::DOUBLE AS lo, 50.0::DOUBLE AS hi FROM (SELECT DISTINCT df FROM sizes WHERE df <= 20000)
    UNION ALL
    SELECT df, step + 1, CASE WHEN {t_sf("(lo + hi) / 2", "df")} > 0.025 THEN (lo + hi) / 2 ELSE lo END,
           CASE WHEN {t_sf("(lo + hi) / 2", "df")} > 0.025 THEN hi ELSE (lo + hi) / 2 END
    FROM size_crit WHERE step < 40""")
view("size_quantile", "sizes size_crit", """
    SELECT df, (lo + hi) / 2 AS crit FROM size_crit WHERE step = 40
    UNION ALL SELECT DISTINCT df, 1.959963984540054 * (1 + (1 + 1.959963984540054 * 1.959963984540054) / (4.0::DOUBLE * df)) FROM sizes WHERE df > 20000""")


def phi(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN 1 - {normal_sf(x)} ELSE {normal_sf(f'(-{x})')} END)"


view("size_power", "size_quantile", f"""
    SELECT peptide, cohen_d, n, sum(w * exp(ln(2) + df / 2 * ln(df / 2) - lgamma(df / 2) + (df - 1) * ln(s) - df * s * s / 2)
               * ({phi("high")} + {phi("low")})) AS power
    FROM (SELECT *, shift - crit * s AS high, -shift - crit * s AS low FROM (SELECT peptide, cohen_d, n, t.df::DOUBLE AS df, abs(cohen_d) * sqrt(n) AS shift, crit,
                 1 + (j - 100) / 100.0::DOUBLE * least(8 / sqrt(2 * t.df::DOUBLE), 0.999999) AS s,
                 (CASE WHEN j IN (0, 200) THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END) / 300.0::DOUBLE * least(8 / sqrt(2 * t.df::DOUBLE), 0.999999) AS w
          FROM sizes t JOIN size_quantile c ON c.df = t.df, range(201) g(j)))
    GROUP BY peptide, cohen_d, n""")
oracle("paired_sample_size", "size_power", f"""
    SELECT peptide, {r("cohen_d")}, n AS pairs_needed, {r("power AS power_reached", "below AS power_below", digits=5)} FROM (
        SELECT *, lag(power) OVER (PARTITION BY peptide ORDER BY n) AS below FROM size_power)
    WHERE power >= 0.8 AND (below < 0.8 OR n = 2)""")
oracle("volcano_flags", "bio2", f"""
    SELECT peptide, {flag("p_t")} AS flag_t, {flag("p_bh")} AS flag_bh, {flag("p_u_bh")} AS flag_u_bh FROM bio2""")
oracle("volcano_frame", "bio2", f"""
    SELECT peptide, {r("log2_fc", "-log10(p_bh) AS neg_log10_p")}, {flag("p_bh")} AS flag FROM bio2""")

THRESHOLD = "CASE WHEN log2_fc = 0.01 THEN 'inf'::DOUBLE ELSE 0.5 / abs(log2_fc - 0.01) END - log10(0.5) AS neg_log10_p"
oracle("volcano_plot", "bio2 info", f"""
    SELECT peptide, {r("log2_fc", "-log10(p_bh) AS neg_log10_p")}, {flag("p_bh")} AS flag, protein AS text, 'point' AS kind
    FROM bio2 LEFT JOIN info USING (peptide)
    UNION ALL SELECT NULL, {r("log2_fc", THRESHOLD)}, NULL, NULL, 'curve'
    FROM (SELECT -1 + i * (2::DOUBLE / 40) AS log2_fc FROM range(41) t(i))""")

# Correlation

view("ccells", "items", """
    SELECT l_suppkey, year(o_orderdate) AS yr, p_brand AS item, round(sum(l_extendedprice), 2) AS x FROM items GROUP BY ALL""")
view("cstats", "ccells", "SELECT item, sum(x) AS sx, sum(x * x) AS sxx FROM ccells GROUP BY item")
view("ccorr", "cstats", """
    SELECT a.item AS p_brand, b.item AS combination,
           (n * coalesce(sxy, 0) - a.sx * b.sx) / nullif(sqrt((n * a.sxx - a.sx ** 2) * (n * b.sxx - b.sx ** 2)), 0) AS correlation
    FROM cstats a, cstats b, (SELECT count(DISTINCT (l_suppkey, yr))::DOUBLE AS n FROM ccells)
    LEFT JOIN (SELECT u.item AS ia, v.item AS ib, sum(u.x * v.x) AS sxy FROM ccells u JOIN ccells v
               ON u.l_suppkey = v.l_suppkey AND u.yr = v.yr GROUP BY ALL) ON ia = a.item AND ib = b.item""")
oracle("cross_correlation", "ccorr", f"SELECT p_brand, combination, {r('correlation')} FROM ccorr")
oracle("correlation_frame", "ccorr", f"SELECT p_brand, combination, {r('correlation', digits=2)} FROM ccorr")


# Classifiers

def logistic_views(source: str, prefix: str, steps: int = 12, scored: str | None = None) -> None:
    """Newton steps from a zero line, one view each, over ``source (analyte, x, y)``; x is centred. ``scored`` has the rows to score."""
    p, target = prefix, scored or source
    view(f"{p}d", source, f"SELECT analyte, x - avg(x) OVER (PARTITION BY analyte) AS x, avg(x) OVER (PARTITION BY analyte) AS mx, y::DOUBLE AS y FROM {source}")
    view(f"{p}0", f"{p}d", f"SELECT analyte, any_value(mx) AS mx, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM {p}d GROUP BY analyte")
    for i in range(1, steps + 1):
        view(f"{p}{i}", f"{p}{i - 1}", f"""
            SELECT analyte, mx, b0 + (wxx * g - wx * gx) / (w * wxx - wx * wx) AS b0, b1 + (w * gx - wx * g) / (w * wxx - wx * wx) AS b1
            FROM (SELECT analyte, mx, b0, b1, sum(mu * (1 - mu)) AS w, sum(mu * (1 - mu) * x) AS wx, sum(mu * (1 - mu) * x * x) AS wxx,
                         sum(y - mu) AS g, sum((y - mu) * x) AS gx
                  FROM (SELECT d.analyte, d.x, d.y, l.mx, b0, b1, 1 / (1 + exp(-(b0 + b1 * d.x))) AS mu
                        FROM {p}d d JOIN {p}{i - 1} l ON l.analyte = d.analyte) GROUP BY analyte, mx, b0, b1)""")
    view(f"{p}fit", f"{p}{steps}", f"SELECT analyte, b0 - b1 * mx AS b0, b1, mx - b0 / b1 AS cutoff FROM {p}{steps}")
    view(f"{p}scored", f"{p}fit {target}", f"""
        SELECT s.*, 1 / (1 + exp(-(b0 + b1 * x))) AS probability, (b0 + b1 * x > 0)::INT AS predicted FROM {target} s JOIN {p}fit USING (analyte)""")
    view(f"{p}conf", f"{p}scored", f"""
        SELECT *, round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 2) AS accuracy, round(tp / nullif(tp + fn, 0)::DOUBLE, 2) AS sensitivity,
               round(tn / nullif(tn + fp, 0)::DOUBLE, 2) AS specificity
        FROM (SELECT analyte, count(*) FILTER (predicted = 1 AND y = 1) AS tp, count(*) FILTER (predicted = 0 AND y = 0) AS tn,
                     count(*) FILTER (predicted = 1 AND y = 0) AS fp, count(*) FILTER (predicted = 0 AND y = 1) AS fn
              FROM {p}scored GROUP BY analyte)""")
    view(f"{p}auc", f"{p}fit {target}", auc_of(f"(SELECT s.analyte, CASE WHEN b1 < 0 THEN -x ELSE x END AS x, y FROM {target} s JOIN {p}fit USING (analyte))"))
    view(f"{p}sep", source, f"""
        SELECT analyte, n, coalesce(h0 <= l1 OR h1 <= l0, TRUE) AS separated FROM (
            SELECT analyte, count(*) AS n, max(x) FILTER (y = 0) AS h0, min(x) FILTER (y = 0) AS l0, max(x) FILTER (y = 1) AS h1,
                   min(x) FILTER (y = 1) AS l1 FROM {source} GROUP BY analyte)""")
    view(f"{p}table", f"{p}conf {p}auc {p}sep", f"""
        SELECT * FROM {p}fit JOIN {p}conf USING (analyte) JOIN {p}auc USING (analyte) JOIN {p}sep USING (analyte)""")


def auc_of(source: str) -> str:
    return f"""
        SELECT analyte, (sum(rk * y) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0) AS auc FROM (
            SELECT analyte, y::DOUBLE AS y, rank() OVER (PARTITION BY analyte ORDER BY x)
                   + (count(*) OVER (PARTITION BY analyte, x) - 1) / 2.0::DOUBLE AS rk FROM {source}) GROUP BY analyte"""


view("docs", "", """
    SELECT d.doc_id, lang AS analyte, ln(n_chars::DOUBLE) AS x, quality AS y FROM labels l JOIN documents d ON d.doc_id = l.doc_id""")
view("families", "docs", """
    SELECT * REPLACE (CASE WHEN analyte IN ('fr', 'es') THEN 'romance' ELSE analyte END AS analyte) FROM docs WHERE analyte <> 'de'""")
view("marks", "items", """
    SELECT p_brand AS analyte, l_extendedprice / 1000 AS x, (l_linestatus = 'O')::INT AS y FROM items""")
logistic_views("docs", "dl")
logistic_views("families", "fl")
logistic_views("marks", "ml")
view("drawn", "docs", """
    SELECT *, row_number() OVER (PARTITION BY analyte ORDER BY md5('1354|' || doc_id)) <= round(0.3::DOUBLE * count(*) OVER (PARTITION BY analyte)) AS is_train
    FROM docs""")
view("trains", "drawn", "SELECT analyte, x, y FROM drawn WHERE is_train")
view("tests", "drawn", "SELECT analyte, x, y FROM drawn WHERE NOT is_train")
logistic_views("trains", "tl", scored="tests")
TABLE = f"{r('accuracy', 'sensitivity', 'specificity')}, {r('cutoff', digits=4)}, {r('auc', digits=2)}, TRUE AS converged, separated"
oracle("logistic_fit", "dlfit dlsep", f"""
    SELECT analyte AS lang, n, {r("b0 AS intercept", "b1 AS slope", "cutoff")}, TRUE AS converged, separated FROM dlfit JOIN dlsep USING (analyte)""")
oracle("score", "dlscored", f"""
    SELECT doc_id, analyte AS lang, {r("x")}, {big("y")}, {r("probability")}, {big("predicted")} FROM dlscored""")
oracle("confusion_metrics", "dlconf", f"""
    SELECT analyte AS lang, tp, tn, fp, fn, {r("accuracy", "sensitivity", "specificity")} FROM dlconf""")
oracle("roc_curve", "marks", f"""
    SELECT analyte AS peptide, {r("fp / n::DOUBLE AS fpr", "tp / p::DOUBLE AS tpr", "cutoff", "(tp + n - fp) / (p + n)::DOUBLE AS accuracy")} FROM (
        SELECT analyte, x AS cutoff, sum(sum(y)) OVER w AS tp, sum(sum(1 - y)) OVER w AS fp,
               sum(sum(y)) OVER (PARTITION BY analyte) AS p, sum(sum(1 - y)) OVER (PARTITION BY analyte) AS n
        FROM marks GROUP BY analyte, x WINDOW w AS (PARTITION BY analyte ORDER BY x DESC)
        UNION ALL SELECT analyte, 'inf'::DOUBLE, 0, 0, sum(y), sum(1 - y) FROM marks GROUP BY analyte)""")
view("mauc", "marks", auc_of("marks"))
oracle("auc", "mauc", f"SELECT analyte AS peptide, {r('auc')} FROM mauc")
oracle("classifier_table", "dltable", f"SELECT analyte AS lang, n, {TABLE} FROM dltable")
oracle("classifier_on_train", "tltable", f"SELECT analyte AS lang, n, {TABLE} FROM tltable")
oracle("marker_subset", "fltable", f"SELECT analyte AS lang, n, {TABLE} FROM fltable")
oracle("merge_performance", "bio2 mltable", f"""
    SELECT peptide, {r("mean_fc", "accuracy", "sensitivity", "specificity")}, {r("auc", digits=2)} FROM bio2 JOIN mltable ON analyte = peptide""")
oracle("marker_score", "bio2 power mltable", f"""
    SELECT peptide, {r("mean_fc", "accuracy")}, {r("power", digits=4)}, {r("auc", digits=2)},
           {r("(mean_fc / max(mean_fc) OVER () + power + accuracy + round(auc, 2)) / 4 AS score", digits=4)}
    FROM bio2 JOIN power USING (peptide) JOIN mltable ON analyte = peptide""")
oracle("logistic_frame", "dlscored", f"""
    SELECT s.analyte AS lang, {r("x", "probability AS fitted")}, {r("cutoff", digits=4)}, {big("y")} FROM dlscored s JOIN dlfit USING (analyte)""")

oracle("logistic_plot", "dlscored", f"""
    SELECT s.analyte AS lang, {r("x", "probability AS fitted")}, {r("cutoff", digits=4)}, {big("y")}, 'point' AS kind FROM dlscored s JOIN dlfit USING (analyte)
    UNION ALL SELECT analyte, {r("x", "1 / (1 + exp(-(b0 + b1 * x))) AS fitted")}, {r("cutoff", digits=4)}, NULL, 'line'
    FROM (SELECT analyte, b0, b1, cutoff, low + (high - low) * i / 100 AS x
          FROM dlfit JOIN (SELECT analyte, min(x) AS low, max(x) AS high FROM docs GROUP BY analyte) USING (analyte), range(101) t(i))""")

# Plot frames

oracle("lod_frame", "conc", f"""
    SELECT peptide, protein, stage_specificity, run, {r("concentration_ug_ml", "rdotp", "lh_rt_diff", "lod")},
           concentration_ug_ml > lod AS above_lod
    FROM conc WHERE concentration_ug_ml > 0 AND rdotp BETWEEN 0.2 AND 1.3""")
oracle("lod_override", "conc", f"""
    SELECT peptide, run, {r("concentration_ug_ml", "rdotp", "lh_rt_diff", "lod", "new_lod")},
           coalesce({decimal_round('concentration_ug_ml', 4)} = {decimal_round('lod', 4)} OR concentration_ug_ml = new_lod OR lh_rt_diff < 0.123, FALSE) AS labelled
    FROM conc LEFT JOIN (SELECT peptide, min(concentration_ug_ml) AS new_lod FROM conc WHERE run = 2 GROUP BY peptide) USING (peptide)""")
view("logs", "gvalues", "SELECT peptide, priority, log10(value) AS lv FROM gvalues WHERE priority <> 'unknown' AND value > 0")
view("boxes", "logs", """
    SELECT peptide, priority, count(*) AS n, avg(lv) AS mean, quantile_cont(lv, 0.25) AS q1, quantile_cont(lv, 0.5) AS median,
           quantile_cont(lv, 0.75) AS q3 FROM logs GROUP BY peptide, priority""")
oracle("strip_summary", "boxes", f"""
    SELECT peptide, priority, b.n, {r("mean", "q1", "median", "q3", "whisker_low", "whisker_high", "pow(10, mean) AS geometric_mean")}, outliers
    FROM boxes b JOIN (
        SELECT peptide, priority, min(lv) FILTER (inside) AS whisker_low, max(lv) FILTER (inside) AS whisker_high,
               count(*) FILTER (NOT inside) AS outliers
        FROM (SELECT l.*, lv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM logs l JOIN boxes USING (peptide, priority))
        GROUP BY peptide, priority) USING (peptide, priority)""")
oracle("strip_outliers", "boxes", f"""
    SELECT peptide, priority, {r("lv AS log10_value")} FROM logs JOIN boxes USING (peptide, priority)
    WHERE NOT lv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
view("seglogs", "gvalues", "SELECT peptide, segment, log10(value) AS lv FROM gvalues WHERE segment <> 'unknown' AND value > 0")
view("segboxes", "seglogs", """
    SELECT peptide, segment, count(*) AS n, avg(lv) AS mean, quantile_cont(lv, 0.25) AS q1, quantile_cont(lv, 0.5) AS median,
           quantile_cont(lv, 0.75) AS q3 FROM seglogs GROUP BY peptide, segment""")
oracle("strip_summary_lod", "segboxes amounts", f"""
    SELECT peptide, segment, b.n, {r("mean", "q1", "median", "q3", "whisker_low", "whisker_high", "pow(10, mean) AS geometric_mean", "lod")}, outliers
    FROM segboxes b JOIN (
        SELECT peptide, segment, min(lv) FILTER (inside) AS whisker_low, max(lv) FILTER (inside) AS whisker_high,
               count(*) FILTER (NOT inside) AS outliers
        FROM (SELECT l.*, lv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM seglogs l JOIN segboxes USING (peptide, segment))
        GROUP BY peptide, segment) USING (peptide, segment) JOIN amounts USING (peptide)""")
oracle("density_histogram", "", f"""
    SELECT bin, {r("bin * 5.0::DOUBLE AS bin_centre")}, n, {r("n / (total * 5.0::DOUBLE) AS density", "mean", "sd",
        "exp(-pow((bin * 5 - mean) / sd, 2) / 2) / (sd * sqrt(2 * pi())) AS normal_density")}
    FROM (SELECT ceil(value / 5 - 0.5)::BIGINT AS bin, count(*) AS n FROM events GROUP BY ALL),
         (SELECT count(value) AS total, avg(value) AS mean, stddev_samp(value) AS sd FROM events)""")

# Normal quantile: published rational approximation, then one Halley step on the Simpson tail.
LOW = "((((({0}*q+{1})*q+{2})*q+{3})*q+{4})*q+{5}) / (((({6}*q+{7})*q+{8})*q+{9})*q+1)".format(
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00,
    2.938163982698783e+00, 7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661606416e+00)
MIDDLE = "((((({0}*u+{1})*u+{2})*u+{3})*u+{4})*u+{5})*h / ((((({6}*u+{7})*u+{8})*u+{9})*u+{10})*u+1)".format(
    -3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01,
    2.506628277459239e+00, -5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
    -1.328068155288572e+01)
oracle("qq_frame", "", f"""
    SELECT event_type, place, {r("value", "p")}, {r("sign(p - 0.5) * (z - e / (1 + z * e / 2)) AS theoretical", digits=4)} FROM (
        SELECT *, (tail - {normal_sf("z")}) * sqrt(2 * pi()) * exp(z * z / 2) AS e FROM (
            SELECT *, -(CASE WHEN tail < 0.02425 THEN {LOW} ELSE {MIDDLE} END) AS z FROM (
                SELECT *, sqrt(-2 * ln(tail)) AS q, tail - 0.5 AS h, (tail - 0.5) ** 2 AS u FROM (
                    SELECT *, least(p, 1 - p) AS tail FROM (
                        SELECT event_type, place, value, (place - a) / (n + 1 - 2 * a) AS p FROM (
                            SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS place,
                                   count(*) OVER (PARTITION BY event_type) AS n,
                                   CASE WHEN count(*) OVER (PARTITION BY event_type) <= 10 THEN 0.375 ELSE 0.5::DOUBLE END AS a FROM events))))))""")
oracle("strict_mean", "", f"""
    SELECT l_orderkey, {r("CASE WHEN count(nullif(l_tax, 0)) = count(*) THEN avg(nullif(l_tax, 0)) END AS mean_tax",
                          "avg(nullif(l_tax, 0)) AS mean_tax_na_rm")} FROM lineitem GROUP BY l_orderkey""")
