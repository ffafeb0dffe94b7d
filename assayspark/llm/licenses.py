"""Licence scans with a positional index of rare licence words.

The index has, for each word of the licence passages, its postings (passage, position). The words that the corpus uses least have
the highest IDF. Of each passage the rarest words are looked up in a file; where they stand, less their position in the
passage, are the places at which the passage can begin. There every word is compared by its relative position: a passage is found
where PERCENT of its words stand, its mandatory key phrase among them. So many of the rarest words are looked up that a
place with enough words must have one of them, so the look-up loses nothing.

Beside the passages there are base phrases, found wherever their words stand consecutively.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import cut_lineage

PERCENT = 80
#: Bytes of text handled at once; a single text may be longer.
SLICE_BYTES = 1 << 20


class Passage(NamedTuple):
    label: str
    text: str
    key: str


# Phrases and labels of the base search, wording of the licences and of the notices that name them.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
PASSAGES = [
    Passage("agpl-3", "under the terms of the GNU Affero General Public License version 3",
            "GNU Affero General Public License version 3"),
    Passage("apache-2", "Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0"),
    Passage("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
            "except in compliance with the License"),
    Passage("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", "in source and binary forms"),
    Passage("bsd-3", "may be used to endorse or promote products derived from this software without specific prior written permission",
            "to endorse or promote products"),
    Passage("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", "Commons Attribution 4.0"),
    Passage("cc-by-nc", "Licensed under CC BY-NC 4.0", "CC BY-NC 4.0"),
    Passage("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
            "Commons Attribution-ShareAlike 4.0"),
    Passage("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
            "this software to the public domain worldwide", "copyright and related and neighboring rights"),
    Passage("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
            "Free Software Foundation", "GNU General Public License as published by"),
    Passage("gpl-2", "licensed under the GNU General Public License, version 2", "General Public License, version 2"),
    Passage("gpl-3", "licensed under the GNU General Public License, version 3", "General Public License, version 3"),
    Passage("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted", "with or without fee is hereby granted"),
    Passage("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
            "the Free Software Foundation", "GNU Lesser General Public License as published by"),
    Passage("mit", "Released under the MIT License", "the MIT License"),
    Passage("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
            "to deal in the Software without restriction"),
    Passage("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
            "Mozilla Public License, v. 2.0"),
    Passage("unlicense", "This is free and unencumbered software released into the public domain",
            "free and unencumbered software"),
]

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "places array<struct<label: string, first: long, n_words: long, share: double>>"
)


class _Words(NamedTuple):
    """Words of several texts in a row."""

    eights: np.ndarray  #: at each byte the number of its and the following seven bytes
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray  #: number of the first word of each text, and the number of all words


def _split(texts: list[bytes]) -> _Words:
    data = _FOLD[np.frombuffer(b" ".join(texts) + b" " * 9, dtype=np.uint8)]
    inside = _IN_WORD[data]
    inside[-9:] = False
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return _Words(np.ndarray((len(data) - 8,), "<u8", data.tobytes(), 0, (1,)), starts, ends, cuts)


def word_list(text: str) -> list[str]:
    """Words of digits, lower-case letters and characters beyond ASCII, A-Z counting as a-z."""
    words = _split([text.encode()])
    data = "".join(chr(c + 32) if 65 <= c <= 90 else chr(c) for c in text.encode()).encode("latin-1")
    return [data[a:b].decode() for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]


class Vocabulary:
    """Numbers of known words, compared whole, eight bytes at a time."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        coded = [w.encode() for w in self.words]
        self.lanes = max((len(w) + 7) // 8 for w in coded)
        own = np.array([[int.from_bytes(w[8 * k:8 * k + 8], "little") for k in range(self.lanes)] for w in coded], dtype=np.uint64)
        self.steps, known = [], np.zeros(len(coded), dtype=np.int64)
        for lane in range(self.lanes):
            values, at = np.unique(own[:, lane], return_inverse=True)
            pairs, following = np.unique(known * len(values) + at, return_inverse=True)
            table = np.full((int(known.max()) + 1) * len(values), -1)
            table[pairs] = np.arange(len(pairs))
            self.steps.append((values, table))
            known = following
        self.number = np.empty(len(coded), dtype=np.int64)
        self.number[known] = np.arange(len(coded))

    def find(self, words: _Words) -> np.ndarray:
        """The number of each word, -1 if it is not known."""
        out = np.full(len(words.starts), -1, dtype=np.int32)
        here, state = np.flatnonzero(words.ends - words.starts <= 8 * self.lanes), None
        for lane, (values, table) in enumerate(self.steps):
            begins = words.starts[here] + 8 * lane
            left = np.clip(words.ends[here] - begins, 0, 8)
            value = words.eights[np.minimum(begins, len(words.eights) - 1)] & _MASKS[left]
            at = np.minimum(np.searchsorted(values, value), len(values) - 1)
            state = table[(0 if state is None else state) * len(values) + at]
            good = (values[at] == value) & (state >= 0)
            here, state = here[good], state[good]
        out[here] = self.number[state]
        return out


@dataclass
class _Template:
    label: str
    words: np.ndarray
    key: np.ndarray  #: positions of the key phrase
    need: int
    seeds: np.ndarray  #: positions of the rarest words


class Index:
    """Passages, their postings of rare words, and base phrases."""

    def __init__(self, passages: list[Passage], phrases: dict[str, str], percent: int):
        split = [(p.label, word_list(p.text), word_list(p.key)) for p in passages]
        based = [(label, word_list(phrase)) for phrase, label in phrases.items()]
        self.vocabulary = Vocabulary([w for _, ws, _ in split for w in ws] + [w for _, ws in based for w in ws])
        number = {w: k for k, w in enumerate(self.vocabulary.words)}
        self.phrases = [(label, np.array([number[w] for w in ws])) for label, ws in based]
        self.templates = []
        for label, ws, key in split:
            at = [k for k in range(len(ws) - len(key) + 1) if ws[k:k + len(key)] == key]
            if not at or not key:
                raise ValueError(f"the key phrase {' '.join(key)!r} does not stand in its passage")
            own, need = np.array([number[w] for w in ws]), -(-len(ws) * percent // 100)
            self.templates.append(_Template(label, own, np.arange(at[0], at[0] + len(key)), need, np.arange(len(ws))))

    def look_up_rarest(self, idf: np.ndarray) -> None:
        for t in self.templates:
            rarest = np.argsort(-idf[t.words], kind="stable")
            t.seeds = np.sort(rarest[:len(t.words) - t.need + 1])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Row number of the first text, and the texts as bytes."""
    held, size, first = [], 0, 0
    for place, text in enumerate(batch["text"].cast(pa.large_binary())):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield first, held
            held, size, first = [], 0, place + 1
    if held:
        yield first, held


def _counter(index: Index):
    """Rows (word, n): documents of the task that hold each word of the index; word -1 counts the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_words = len(index.vocabulary.words)
        held, docs = np.zeros(n_words, dtype=np.int64), 0
        for batch in batches:
            for _, texts in _slices(batch):
                words = _split(texts)
                found = index.vocabulary.find(words)
                doc = np.repeat(np.arange(len(texts)), np.diff(words.cuts))
                seen = np.unique(doc[found >= 0] * n_words + found[found >= 0])
                held += np.bincount(seen % n_words, minlength=n_words)
                docs += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, n_words), pa.int32()), pa.array(np.r_[docs, held], pa.int64())], ["word", "n"]
        )

    return count


def _inverse_frequencies(texts: DataFrame, index: Index) -> np.ndarray:
    """IDF of each word of the index over all documents; the index bounds the rows that reach the driver."""
    counted = cut_lineage(texts.mapInArrow(_counter(index), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")))
    n = {r.word: r.n for r in counted.collect()}
    return np.array([log((1 + n.get(-1, 0)) / (1 + n.get(k, 0))) for k in range(len(index.vocabulary.words))])


def _places(found: np.ndarray, doc: np.ndarray, cuts: np.ndarray, index: Index) -> Iterator[tuple[str, bool, int, np.ndarray, np.ndarray]]:
    """(label, whether a base phrase, words, first words, shares) of whatever is found."""
    for label, phrase in index.phrases:
        n = len(phrase)
        at = np.flatnonzero(found[:max(0, len(found) - n + 1)] == phrase[0])
        for k in range(1, n):
            at = at[found[at + k] == phrase[k]]
        at = at[doc[at] == doc[at + n - 1]]
        yield label, True, n, at, np.ones(len(at))
    known = np.flatnonzero(found >= 0)
    known = known[np.argsort(found[known], kind="stable")]
    bounds = np.searchsorted(found[known], np.arange(len(index.vocabulary.words) + 1))
    for t in index.templates:
        n = len(t.words)
        starts = []
        for seed in t.seeds:
            word = t.words[seed]
            where = known[bounds[word]:bounds[word + 1]]
            starts.append((where - seed)[(where - seed >= cuts[doc[where]]) & (where - seed + n <= cuts[doc[where] + 1])])
        at = np.unique(np.concatenate(starts))
        for k in t.key:
            at = at[found[at + k] == t.words[k]]
        same = (found[at[:, None] + np.arange(n)] == t.words).sum(axis=1)
        good = same >= t.need
        yield t.label, False, n, at[good], same[good] / n


def _scanner(index: Index, schema: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, len(texts)), *_scan(texts, index, schema)], schema=schema
                )

    return scan


def _scan(texts: list[bytes], index: Index, schema: pa.Schema) -> Iterator[pa.Array]:
    words = _split(texts)
    counts, n = np.diff(words.cuts), len(texts)
    doc = np.repeat(np.arange(n), counts)
    n_base, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    base, labels, score = [set() for _ in texts], [set() for _ in texts], np.zeros(n)
    places: list[list[dict]] = [[] for _ in texts]
    for label, is_base, length, at, shares in _places(index.vocabulary.find(words), doc, words.cuts, index):
        owners = doc[at]
        own = at - words.cuts[owners]
        np.maximum.at(score, owners, shares)
        if is_base:
            n_base += np.bincount(owners, minlength=n)
            np.minimum.at(low, owners, own)
            np.maximum.at(high, owners, own)
        for k, place, share in zip(owners.tolist(), own.tolist(), shares.tolist(), strict=True):
            labels[k].add(label)
            if is_base:
                base[k].add(label)
            places[k].append({"label": label, "first": place, "n_words": length, "share": share})
    none = n_base == 0
    values = [counts, n_base, pa.array(low, mask=none), pa.array(high, mask=none), [",".join(sorted(x)) for x in base],
              [",".join(sorted(x)) for x in labels], score,
              [sorted(p, key=lambda x: (x["first"], x["label"], x["n_words"])) for p in places]]
    for name, value in zip(schema.names[1:], values, strict=True):
        own = schema.field(name).type
        yield value.cast(own) if isinstance(value, pa.Array) else pa.array(value, own)


def license_scan(
    docs: DataFrame, passages: list[Passage] = PASSAGES, phrases: dict[str, str] = BASE_PHRASES, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    A word is a run of digits, letters a-z (A-Z count as these) and characters beyond ASCII. n_base counts the places where the words
    of a base phrase stand consecutively, overlapping ones too; first_word and last_word are the smallest and largest
    number of a first word of these, null without any. base_labels has the labels of these phrases, labels those of the passages as
    well, each once, in order of code points, joined by commas; empty without any. A passage is found where ``percent`` of its
    words stand at their relative positions in one document, all of its key phrase among them. ``places`` has the first word, length and
    share of words of all of both; score is the largest share, 0 without a place. A null text counts as empty. Repeated rows and null
    doc_ids stay rows of the result. Other columns are not read.
    """
    index = Index(passages, phrases, percent)
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    index.look_up_rarest(_inverse_frequencies(own.select("text"), index))
    empty = own.select("doc_id").limit(0)
    for field in RESULT.split(", ", 7):
        name, kind = field.split(" ", 1)
        empty = empty.withColumn(name, F.lit(None).cast(kind))
    from pyspark.sql.pandas.types import to_arrow_schema

    return own.mapInArrow(_scanner(index, to_arrow_schema(empty.schema)), empty.schema)
