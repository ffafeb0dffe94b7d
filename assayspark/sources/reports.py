"""Instrument reports and peptide dimensions from CSV; result tables to files."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Report headers (a space may stand for each dot) and their canonical names.
MULTISET_HEADERS = {
    "Replicate.Name": "replicate_name",
    "Analyte.Concentration": "fmol_ul",
    "Peptide.Sequence": "peptide",
    "Peptide.Modified.Sequence": "peptide_mods",
    "Sample.Type": "sample_type",
    "Isotope.Label.Type": "isotope",
    "Precursor.Mz": "precursor_mz",
    "Precursor.Charge": "precursor_charge",
    "Product.Mz": "product_mz",
    "Product.Charge": "product_charge",
    "Fragment.Ion": "fragment_ion",
    "Retention.Time": "retention_time",
    "Area": "area",
    "Max.Height": "max_height",
    "Background": "background",
    "RatioLightToHeavy": "lth",
    "DotProductLightToHeavy": "rdotp",
    "Peak.Rank": "transition_rank",
    "subjectID": "subject_id",
    "condition": "condition",
    "timepoint": "timepoint",
    "curvepoint": "curvepoint",
    "histology": "histology",
    "tese": "tese",
    "texlevel": "texlevel",
}
CALIBRATION_HEADERS = {
    "Peptide.Sequence": "peptide",
    "Peptide.Modified.Sequence": "peptide_mods",
    "Protein.Name": "protein",
    "SubjectID": "subject_id",
    "BioReplicate": "bioreplicate",
    "Condition": "condition",
    "Sample.Type": "sample_type",
    "Replicate.Name": "replicate_name",
    "Isotope.Label.Type": "isotope",
    "Precursor.Mz": "precursor_mz",
    "Precursor.Charge": "precursor_charge",
    "Product.Mz": "product_mz",
    "Product.Charge": "product_charge",
    "Fragment.Ion": "fragment_ion",
    "Retention.Time": "retention_time",
    "Area": "area",
    "Background": "background",
    "RatioLightToHeavy": "lth",
    "Analyte.Concentration": "fmol_ul",
    "Ratio.To.Standard": "ratio_to_standard",
    "DotProductLightToHeavy": "rdotp",
    "Peak.Rank": "transition_rank",
}
DIALECTS = {"multiset": MULTISET_HEADERS, "calibration": CALIBRATION_HEADERS}

# Canonical columns that are not text.
TYPES = {
    **dict.fromkeys(
        ["fmol_ul", "precursor_mz", "product_mz", "retention_time", "area", "max_height",
         "background", "lth", "rdotp", "curvepoint", "ratio_to_standard"],
        "double",
    ),
    **dict.fromkeys(["precursor_charge", "product_charge", "transition_rank"], "int"),
}

INFO_SCHEMA = {"peptide": "string", "protein": "string", "mw": "double", "stage_specificity": "string"}
CONCENTRATION_SCHEMA = {"peptide": "string", "fmol_ug": "double", "loq_ug_ml": "double", "lod": "double"}
CURVE_CONCENTRATION_SCHEMA = {"peptide": "string", "fmol_ug": "double", "linlim": "double"}
DIMENSION_ALIASES = {"stageSpecificity": "stage_specificity", "fmolug": "fmol_ug"}


def _dotted(header: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.]", ".", header.strip())


def normalise_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename report headers to canonical names; an absent header is an error, extra ones stay."""
    present = {_dotted(c): c for c in df.columns}
    absent = [h for h in mapping if h not in present]
    if absent:
        raise ValueError(f"report lacks columns {absent}")
    return df.withColumnsRenamed({present[h]: name for h, name in mapping.items()})


def _typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns and t != "string"})


def _headers(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """The headers as written, for the names Spark gives: it adds the place to headers that are equal but for case."""
    bare = [c.removesuffix(str(k)) for k, c in enumerate(names)]
    folded = [c.lower() for c in bare]
    if not any(b != c and folded.count(b.lower()) > 1 for b, c in zip(bare, names, strict=True)):
        return names
    first = spark.read.csv(path).first()
    return [h if h and c == f"{h}{k}" else c for k, (h, c) in enumerate(zip(first, names, strict=True))]


def read_report(
    spark: SparkSession, path: str, dialect: str = "multiset", blank_as_null: bool = False
) -> DataFrame:
    """Long report, one row per measurement, transition and isotope; ``#N/A`` is the missing marker.

    ``row_id`` orders rows as in the file (file, split, position in the split). Columns outside the dialect's headers
    stay, as text and under their own name, unless a canonical column has that name.
    """
    raw = spark.read.option("header", True).option("nullValue", "#N/A").csv(path)
    placed = raw.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("position"),
        ).alias("row_id"),
    )
    mapping = DIALECTS[dialect]
    own = [*mapping.values(), "row_id"]
    headers = dict(zip(raw.columns, _headers(spark, path, raw.columns), strict=True))
    extra = [c for c, h in headers.items() if _dotted(h) not in mapping and h.lower() not in own]
    kept = [F.col(f"`{c}`").alias(c if c in extra else h) for c, h in headers.items() if c in extra or _dotted(h) in mapping]
    named = normalise_columns(placed.select(*kept, "row_id"), mapping)
    named = named.select(*own, *[F.col(f"`{c}`") for c in extra])
    typed = _typed(named, TYPES)
    if not blank_as_null:
        return typed
    text = [c for c in mapping.values() if c not in TYPES]
    return typed.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text})


def read_dimension(spark: SparkSession, path: str, schema: Mapping[str, str], key: str = "peptide") -> DataFrame:
    """Dimension table by column name; a repeated key is an error."""
    raw = spark.read.option("header", True).option("nullValue", "NA").csv(path)
    named = raw.withColumnsRenamed(DIMENSION_ALIASES)
    absent = [c for c in schema if c not in named.columns]
    if absent:
        raise ValueError(f"dimension lacks columns {absent}")
    table = _typed(named.select(*schema), schema)
    assert_unique(table, [key])
    return table


def assert_unique(df: DataFrame, key: list[str]) -> None:
    repeated = df.groupBy(*key).count().filter(F.col("count") > 1).limit(1).collect()
    if repeated:
        raise ValueError(f"key {key} repeats: {repeated[0]}")


def write_report(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """One folder per named result table."""
    for name, table in tables.items():
        writer = table.write.mode(mode).format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{path.rstrip('/')}/{name}")
