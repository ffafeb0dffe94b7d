from __future__ import annotations

import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name in spark.checkpoint.dir."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents from texts, with columns that clash with names the operators use."""

    def make(texts, ids=None, sources=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [
            (i, t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k], len(t or ""), 1, "x", 2.0)
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))
        ]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, n long, node string, rank double"
        )

    return make
