"""Assay-shaped views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayspark.functions.expressions import fill_defaults
from assayspark.operators.joins import enrich_left
from assayspark.operators.replicates import with_spike
from assayspark.operators.scale import session_partitions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part's brand and their order."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return table(spark, sf_dir, "lineitem").join(parts, "l_partkey").join(orders, "l_orderkey")


def customer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return line_items(spark, sf_dir).join(customers, "o_custkey")


def peptide_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand, taken as the peptide."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("peptide")).agg(
        F.avg("p_retailprice").alias("mw"), F.min("p_type").alias("stage_specificity"),
    ).withColumn("protein", F.concat(F.lit("P_"), F.col("peptide")))


def peptide_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("peptide")).agg(
        F.avg(F.col("p_size").cast("double")).alias("fmol_ug"),
        (F.avg("p_retailprice") * 1e-4).alias("loq_ug_ml"),
        (F.avg("p_retailprice") * 5e-5).alias("lod"),
        F.lit(2.0).alias("linlim"),
    )


def assay_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long report: brand as peptide, region as subject, segment as condition, return flag as fragment,
    line number as replicate, line status as isotope.
    """
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("string").alias("subject_id")
    )
    cells = customer_items(spark, sf_dir).join(nations, "c_nationkey").groupBy(
        F.col("p_brand").alias("peptide"), "subject_id", F.col("c_mktsegment").alias("condition"),
        F.col("l_returnflag").alias("fragment_ion"), F.col("l_linenumber").cast("bigint").alias("run"),
        F.when(F.col("l_linestatus") == "F", "heavy").otherwise("light").alias("isotope"),
    ).agg(
        F.avg("l_extendedprice").alias("area"), F.avg("l_tax").alias("background"),
        F.max("l_extendedprice").alias("max_height"), F.avg("l_quantity").alias("retention_time"),
        F.avg("l_discount").alias("lth"), (1 - F.avg("l_discount")).alias("rdotp"),
        F.max("l_quantity").alias("precursor_mz"), F.min("l_quantity").alias("product_mz"),
    )
    rank = F.when(F.col("fragment_ion") == "A", 1).when(F.col("fragment_ion") == "N", 2).otherwise(3)
    return cells.withColumns({
        "set": F.lit("tables"),
        "timepoint": F.lit("1"),
        "curvepoint": F.col("subject_id").cast("double") + 1,
        "peptide_mods": F.col("peptide"),
        "precursor_charge": F.lit(2),
        "product_charge": F.lit(1),
        "transition_rank": rank,
        "histology": F.concat(F.lit("H"), F.col("subject_id")),
        "tese": F.concat(F.lit("T"), F.col("fragment_ion")),
        "texlevel": F.concat(F.lit("X"), F.col("run").cast("string")),
        "replicate_name": F.concat_ws(
            "", F.col("run").cast("string"), F.lit("_S"), F.col("subject_id"), F.lit("_"), F.col("condition"),
            F.lit("_rep"), F.col("run").cast("string"),
        ),
        "row_id": F.concat_ws(
            "|", "peptide", "subject_id", "condition", "fragment_ion", F.col("run").cast("string"), "isotope"
        ),
    })


def assay_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with its dimensions, spike amounts and defaults."""
    with_protein = enrich_left(
        assay_report(spark, sf_dir), peptide_info(spark, sf_dir), "peptide", ["protein"]
    )
    described = enrich_left(
        with_protein, peptide_amounts(spark, sf_dir), "peptide", ["fmol_ug", "loq_ug_ml", "lod"]
    )
    return fill_defaults(with_spike(described))


def curve_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration rows: every line item, line number as curve point, priority as trial."""
    rows = line_items(spark, sf_dir)
    amounts = peptide_amounts(spark, sf_dir).select("peptide", "fmol_ug")
    measured = rows.select(
        F.col("p_brand").alias("peptide"), F.col("l_linenumber").cast("double").alias("curvepoint"),
        F.col("o_orderpriority").alias("trial"), F.col("l_discount").alias("lth"),
        (1 - F.col("l_discount")).alias("rdotp"),
    )
    return with_spike(enrich_left(measured, amounts, "peptide", ["fmol_ug"]))


def group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per line item with its brand and three factors."""
    return customer_items(spark, sf_dir).select(
        F.col("p_brand").alias("peptide"),
        (F.col("l_extendedprice") * F.col("l_quantity") / 50).alias("value"), "l_quantity",
        F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "unknown")
        .otherwise(F.col("o_orderpriority")).alias("priority"),
    )


def before_after(spark: SparkSession, sf_dir: str, subject: str = "c_nationkey") -> DataFrame:
    """Line items before (status F) and after, per subject and brand."""
    return customer_items(spark, sf_dir).select(
        F.col(subject).alias("subject_id"), F.col("p_brand").alias("peptide"),
        F.when(F.col("l_linestatus") == "F", "PRE").otherwise("POST").alias("condition"), "l_extendedprice",
    )


def followed_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price per customer, brand and order year. Dealt by customer and brand once, which serves all that goes on by both."""
    rows = line_items(spark, sf_dir).select("o_custkey", "p_brand", "o_orderdate", "l_extendedprice")
    return rows.repartition(session_partitions(spark), "o_custkey", "p_brand").groupBy(
        F.col("o_custkey").alias("subject_id"), F.col("p_brand").alias("peptide"),
        F.year("o_orderdate").cast("bigint").alias("timepoint"),
    ).agg(F.avg("l_extendedprice").alias("concentration_ug_ml"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log length of each labelled document with its language and quality label."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return labels.join(documents, "doc_id").select(
        "doc_id", "lang", F.ln(F.col("n_chars").cast("double")).alias("x"), F.col("quality").alias("y")
    )


def marker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, price in thousands, label 1 for those after (see ``before_after``)."""
    return line_items(spark, sf_dir).select(
        F.col("p_brand").alias("peptide"), (F.col("l_extendedprice") / 1000).alias("x"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("y"),
    )
