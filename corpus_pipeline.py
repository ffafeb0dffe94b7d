"""A training corpus from raw documents: known languages, one of each group of near copies, no benchmark, mixed, as token files."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayspark.llm import langid
from assayspark.llm.common import cut_lineage, join_small, scratch_folder, table
from assayspark.llm.decontaminate import without_leaks
from assayspark.llm.jaccard import jaccard_groups
from assayspark.llm.mixing import mix, repeat_rows
from assayspark.llm.tokens import document_digests, read_token_blocks, write_token_blocks

#: Below this cosine a text is like none of the languages: two random profiles stay within 0.06 of 0.
LEAST_SCORE = 0.06


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or unlike every language go."""
    prototypes = langid.language_prototypes(langid.trained_on(docs))
    # The row rides along as one column, so no name of its own clashes with the found ones.
    found = langid.identify(docs.select(F.struct("*").alias("row"), "text"), prototypes)
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(sure).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group that five-word shingles link at 0.8 or more; repeated rows once."""
    groups = jaccard_groups(docs, size=5, percent=80)
    gone = cut_lineage(groups.filter("doc_id != component_id").select("doc_id").distinct())
    kept = join_small(docs, gone, ["doc_id"], "left_anti", 16)
    # Only rows that share a doc_id can be repeated rows; the others need no look at their texts.
    shared = cut_lineage(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"))
    return join_small(kept, shared, ["doc_id"], "left_anti", 16).unionByName(
        join_small(kept, shared, ["doc_id"], "left_semi", 16).dropDuplicates()
    )


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return repeat_rows(mix(docs)).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; what they hold, read back: doc_id, start, n_tokens, ids_crc32."""
    path = f"{scratch_folder(spark)}/corpus-{uuid4().hex}"
    write_token_blocks(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return document_digests(read_token_blocks(spark, path))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("mixing to target weights", to_target_weights),
    ("token-ID output", token_files),
]
#: SQL can't express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
