"""Registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayspark.llm import langid
from assayspark.llm.bytespans import strip_repeats
from assayspark.llm.centroids import cluster_digests, cluster_vectors
from assayspark.llm.codes import code_digests, compress_vectors
from assayspark.llm.common import scratch_folder, table
from assayspark.llm.decontaminate import leaked_documents
from assayspark.llm.jaccard import jaccard_groups
from assayspark.llm.licenses import license_scan
from assayspark.llm.lines import delete_repeated_runs
from assayspark.llm.maintext import extract_main_text
from assayspark.llm.mixing import mix
from assayspark.llm.tokens import document_digests, read_token_blocks, write_token_blocks
from assayspark.llm.unigram import token_counts
from assayspark.llm.vectors import near_vectors


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after repeated runs of three lines, or of 50 words, are deleted, as a digest."""
    left = delete_repeated_runs(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "lines_total", "lines_removed", "runs_removed",
        F.md5(F.coalesce("lines_kept", F.lit(""))).alias("kept_md5"),
    )


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/tokens-{uuid4().hex}"
    write_token_blocks(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return document_digests(read_token_blocks(spark, path))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_words", "n_tokens")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = strip_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.language_prototypes(langid.trained_on(docs))
    found = langid.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(*compress_vectors(table(spark, sf_dir, "embeddings")))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("places")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_digests(*cluster_vectors(table(spark, sf_dir, "embeddings")))


QUERIES = {
    f.__name__: f for f in (
        op1_line_dedup, op2_near_vectors, op3_jaccard_join, op4_token_blocks, op5_token_counts, op6_decontamination,
        op7_suffix_dedup, op8_main_text, op9_language_id, op10_source_mix, op11_vector_codes, op12_license_scan,
        op13_centroid_clusters,
    )
}
