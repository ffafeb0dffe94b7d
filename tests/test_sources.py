"""CSV reports in both dialects, dimensions, the load of a set, result tables and the whole studies."""

import pytest
from pyspark.sql import functions as F

from assayspark.operators.ingest import load_assay_set, load_calibration
from assayspark.plans.studies import biomarker_study, calibration_study, sample_set_study
from assayspark.sources import reports

HEADER = (
    "Replicate Name,Analyte Concentration,Peptide Sequence,Peptide Modified Sequence,Sample Type,Isotope Label Type,"
    "Precursor Mz,Precursor Charge,Product Mz,Product Charge,Fragment Ion,Retention Time,Area,Max Height,Background,"
    "RatioLightToHeavy,DotProductLightToHeavy,Peak Rank,subjectID,condition,timepoint,curvepoint,histology,tese,texlevel"
)
INFO = "peptide,protein,mw,stage_specificity\nPEPA,PA,1000,germ\nPEPB,PB,2000,epi\n"
AMOUNTS = "peptide,fmol_ug,loq_ug_ml,lod\nPEPA,10,0.1,0.05\nPEPB,NA,0.2,0.1\n"


def line(run, rep, subject, condition, peptide, isotope, area, lth, background="5", time="1", texlevel="hi"):
    return (
        f"{run}_{subject}_rep{rep},1,{peptide},{peptide},u,{isotope},500,2,300,1,y4,20.5,{area},7,{background},{lth},0.9,1,"
        f"{subject},{condition},{time},1,h{condition},t{condition},{texlevel}"
    )


@pytest.fixture
def files(tmp_path):
    rows = [HEADER]
    for s in range(8):
        condition = "PRE" if s < 4 else "POST"
        for peptide, factor in (("PEPA", 1.0), ("PEPB", 2.0)):
            for rep in (1, 2):
                run = s * 2 + rep
                lth = round(factor * (1 + 0.3 * s + 0.1 * ((s * 7 + rep) % 3)), 3)
                rows += [
                    line(run, rep, f"S{s % 4}", condition, peptide, "heavy", 100 + s, lth),
                    line(run, rep, f"S{s % 4}", condition, peptide, "light", "#N/A" if s == 0 else 50 + s, lth, "0", texlevel="NA"),
                ]
    for name, text in (("report", "\n".join(rows)), ("info", INFO), ("amounts", AMOUNTS)):
        (tmp_path / f"{name}.csv").write_text(text + "\n")
    return {"report": f"{tmp_path}/report.csv", "peptide_info": f"{tmp_path}/info.csv",
            "peptide_concentration": f"{tmp_path}/amounts.csv"}


def test_report_keeps_other_columns(spark, files):
    with open(files["report"]) as file:
        lines = file.read().splitlines()
    path = files["report"].replace("/report.csv", "/wider.csv")
    with open(path, "w") as file:
        file.write("\n".join([lines[0] + ",Operator Name,area"] + [f"{x},Kim {k},none" for k, x in enumerate(lines[1:])]) + "\n")
    report = reports.read_report(spark, path)
    plain = reports.read_report(spark, files["report"])
    assert report.columns == [*plain.columns, "Operator Name"]
    assert report.filter("`Operator Name` = 'Kim 3'").count() == 1
    assert report.filter("area IS NULL").count() == plain.filter("area IS NULL").count()


def test_headers_equal_but_for_case(spark, files):
    """Spark numbers such headers by place; a header that ends in its place by itself stays."""
    with open(files["report"]) as file:
        lines = file.read().splitlines()
    path = files["report"].replace("/report.csv", "/cases.csv")
    n = len(lines[0].split(","))
    with open(path, "w") as file:
        file.write("\n".join([f"{lines[0]},AREA,Note,Mark{n + 2},note"] + [f"{x},none,a,b,c" for x in lines[1:]]) + "\n")
    report = reports.read_report(spark, path)
    plain = reports.read_report(spark, files["report"])
    assert report.columns == [*plain.columns, f"Note{n + 1}", f"Mark{n + 2}", f"note{n + 3}"]
    assert report.filter("area IS NULL").count() == plain.filter("area IS NULL").count()


def test_report_types_and_missing_marker(spark, files):
    report = reports.read_report(spark, files["report"])
    assert dict(report.dtypes)["area"] == "double" and dict(report.dtypes)["precursor_charge"] == "int"
    assert report.count() == 64 and report.filter("area IS NULL").count() == 4
    assert report.filter("texlevel = 'NA'").count() == 32
    assert report.select("row_id").distinct().count() == 64
    assert report.orderBy("row_id").first().isotope == "heavy"


def test_absent_header_is_an_error(spark, files):
    with pytest.raises(ValueError, match="lacks"):
        reports.read_report(spark, files["peptide_info"])


def test_dimension_missing_marker_and_unique_key(spark, files, tmp_path):
    table = reports.read_dimension(spark, files["peptide_concentration"], reports.CONCENTRATION_SCHEMA)
    assert {r.peptide: r.fmol_ug for r in table.collect()} == {"PEPA": 10.0, "PEPB": None}
    (tmp_path / "twice.csv").write_text(INFO + "PEPA,PX,1,x\n")
    with pytest.raises(ValueError, match="repeats"):
        reports.read_dimension(spark, f"{tmp_path}/twice.csv", reports.INFO_SCHEMA)


def test_load_drops_botched_and_fills(spark, files):
    loaded = load_assay_set(spark, files, "set1", botched=[3])
    assert loaded.count() == 60 and loaded.filter("run = 3").count() == 0
    row = loaded.filter("peptide = 'PEPA' and isotope = 'light'").first()
    assert (row.background, row.fmol_ul, row["set"], row.protein) == (1.0, 400.0, "set1", "PA")


def test_report_round_trip(spark, tmp_path):
    table = spark.range(5).withColumn("x", F.col("id") / 2)
    for fmt in ("parquet", "csv"):
        reports.write_report({"limits": table, "curve": table}, f"{tmp_path}/{fmt}", fmt)
        back = spark.read.format(fmt).option("header", True).load(f"{tmp_path}/{fmt}/limits")
        assert back.count() == 5 and back.columns == ["id", "x"]


def test_sample_set_and_biomarker_studies(spark, files):
    amounts = reports.read_dimension(spark, files["peptide_concentration"], reports.CONCENTRATION_SCHEMA)
    assert amounts.count() == 2
    loaded = load_assay_set(spark, files, "set1")
    info = reports.read_dimension(spark, files["peptide_info"], reports.INFO_SCHEMA)
    study = sample_set_study([loaded], info, ["condition"], alpha=1.0)
    found = study["concentrations"]
    assert found.count() == 16
    row = found.filter("peptide = 'PEPA' and subject_id = 'S1' and condition = 'POST'").first()
    assert row.concentration_ug_ml == pytest.approx(row.lth * 400 * 1000 * 1e-6)
    tests = {r.test for r in study["group_tests"].filter("peptide = 'PEPA'").collect()}
    assert {"anova", "kruskal", "tukey", "duncan", "dunn"} <= tests
    labelled = found.filter("peptide = 'PEPA'").withColumn("y", (F.col("condition") == "POST").cast("int"))
    markers = biomarker_study(labelled, "subject_id", "condition", ("PRE", "POST"), "concentration_fm_ul",
                              "y", "concentration_ug_ml")
    best = markers["scores"].first()
    assert best.peptide == "PEPA" and best.n == 4 and best.auc == 1.0


def test_calibration_study(spark, tmp_path):
    header = ("Peptide Sequence,Peptide Modified Sequence,Protein Name,SubjectID,BioReplicate,Condition,Sample Type,Replicate Name,"
              "Isotope Label Type,Precursor Mz,Precursor Charge,Product Mz,Product Charge,Fragment Ion,Retention Time,Area,"
              "Background,RatioLightToHeavy,Analyte Concentration,Ratio To Standard,DotProductLightToHeavy,Peak Rank")
    rows = [header]
    for point in ("0_1", "1", "10", "100"):
        for rep in (1, 2, 3):
            ratio = (1 / float(point.replace("_", "."))) * (1 + 0.02 * rep) * (3 if point == "0_1" and rep == 1 else 1)
            for isotope in ("heavy", "light"):
                rows.append(f"PEPA,PEPA,x,S,1,C,u,1_P{point}-rep{rep},{isotope},5,2,3,1,y4,20,{100 if isotope == 'heavy' else 100 * ratio},"
                            f"1,{0 if point == '10' else ratio},1,1,0.9,1")
    (tmp_path / "r.csv").write_text("\n".join(rows) + "\n")
    (tmp_path / "i.csv").write_text("peptide,protein,mw,stageSpecificity\nPEPA,PA,1000,germ\n")
    (tmp_path / "a.csv").write_text("peptide,fmolug,linlim\nPEPA,10,1\n")
    prepared = load_calibration(spark, {"report": f"{tmp_path}/r.csv", "peptide_info": f"{tmp_path}/i.csv",
                                        "peptide_concentration": f"{tmp_path}/a.csv"})
    info = reports.read_dimension(spark, f"{tmp_path}/i.csv", reports.INFO_SCHEMA)
    amounts = reports.read_dimension(spark, f"{tmp_path}/a.csv", reports.CURVE_CONCENTRATION_SCHEMA)
    study = calibration_study(prepared, info, amounts)
    limit = study["limits"].first()
    assert limit.loq_point == 1.0 and limit.protein == "PA"
    fit = study["fits"].first()
    assert fit.n == 3 and fit.r2 == pytest.approx(1.0, abs=1e-6)
    assert study["replicates"].filter("curvepoint = 10").first().lth > 0
