"""The corpus pipeline stage by stage against brute force at the smallest size, and the registered queries' columns."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from assayspark.llm.common import cut_lineage

from test_corpus import brute_jaccard, lowest, prose

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF).cache())
        assert frames[-1].columns == columns, name
    known, single, clean, mixed = frames[1:]
    lettered = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in known.collect()} <= lettered
    assert known.count() >= 0.98 * len(lettered)
    sets, links = brute_jaccard([(r.doc_id, r.text) for r in known.collect()], 5, 80)
    assert {r.doc_id for r in single.collect()} == {i for i, c in lowest(sets, links).items() if i == c}
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in single.collect() if any(x in r.text.lower() for x in items)}
    assert leaked and not leaked & {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()} - leaked == set()
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    last = corpus_pipeline.token_files(spark, mixed, SF).collect()
    assert len(last) == mixed.count()
    assert sorted(r.start for r in last)[0] == 0


@pytest.mark.parametrize("rows", [0, 40])
def test_stages_of_odd_tables(spark, documents, rows):
    """Empty tables, null ids, texts and sources, repeated rows, very long texts, extra columns that clash."""
    texts = [prose(k, 30) for k in range(rows)]
    if rows:
        texts[1:7] = [None, "", " \n", texts[0], prose(77, 20000), "7 7 7"]
    docs = documents(texts, [None if k % 9 == 8 else k for k in range(rows)], [None if k % 4 else "s" for k in range(rows)])
    docs = docs.withColumnsRenamed({"n": "_found", "node": "lang_pred"}).withColumn("row", F.lit(1))
    docs = docs.unionByName(docs.filter("doc_id = 0 or doc_id is null"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = cut_lineage(stage(spark, now, SF))
        assert now.columns == docs.columns, name
        assert (now.count() > 0) == (rows > 0), name
    kept = [r.text for r in now.collect()]
    assert len({t for t in kept}) <= len({t for t in texts})
    assert corpus_pipeline.token_files(spark, now, SF).count() == len(kept)


def test_registered_queries(spark):
    found = queries()
    names = {m[0] for n in found if (m := re.match(r"op\d+", n))}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in found
