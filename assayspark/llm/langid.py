"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors,
each rotated by its place; a text is the sum of its n-grams, and a language the sum of its labelled
texts. A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import cut_lineage, fresh_name, take_worker

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: n-gram vectors a worker remembers; when full it starts anew. Results don't depend on it.
MEMORY = 20_000
_OTHER = re.compile(r"[\W\d_]+")
_letters: dict[str, np.ndarray] = {}
_rows: dict[int, int] = {}
#: One byte a component, as they are +1 and -1: a full memory takes 20 MB.
_vectors = np.zeros((0, DIMENSIONS), dtype=np.int8)


def letter_vector(letter: str) -> np.ndarray:
    """The letter's random vector; it depends on its code point alone."""
    if letter not in _letters:
        draw = np.random.Generator(np.random.Philox(key=ord(letter))).integers(0, 2, DIMENSIONS)
        _letters[letter] = (2 * draw - 1).astype(np.int8)
    return _letters[letter]


def gram_vector(gram: str) -> np.ndarray:
    """Product of the letters' vectors, the first rotated most."""
    bound = letter_vector(gram[-1])
    for back, letter in enumerate(reversed(gram[:-1]), 1):
        bound = bound * np.roll(letter_vector(letter), back)
    return bound


def _gram_rows(keys: list[int]) -> list[int]:
    """Rows of the remembered vectors for n-grams packed into numbers; at most MEMORY keys at a time."""
    global _vectors
    missing = [k for k in keys if k not in _rows]
    if len(_rows) + len(missing) > MEMORY:
        _rows.clear()
        _letters.clear()
        missing = keys
    if len(_rows) + len(missing) > len(_vectors):
        larger = np.zeros((min(MEMORY, 2 * (len(_rows) + len(missing))), DIMENSIONS), dtype=np.int8)
        larger[:len(_vectors)] = _vectors
        _vectors = larger
    for key in missing:
        gram = "".join(chr(key >> 21 * back & 0x1FFFFF) for back in range(GRAM - 1, -1, -1))
        _vectors[len(_rows)] = gram_vector(gram)
        _rows[key] = len(_rows)
    return [_rows[k] for k in keys]


def _forget() -> None:
    """Give back what the worker remembers; the process goes on to other tasks."""
    global _vectors
    _rows.clear()
    _letters.clear()
    _vectors = np.zeros((0, DIMENSIONS), dtype=np.int8)


def normalised(text: str | None) -> str:
    """Lower-case letters with one blank between words and at either end; empty without a letter."""
    bare = _OTHER.sub(" ", text or "").strip().lower()
    return f" {bare} " if bare else ""


def text_vector(text: str | None) -> np.ndarray | None:
    """Sum of the whole text's n-gram vectors; None without a letter."""
    plain = normalised(text)
    if not plain:
        return None
    points = np.frombuffer(plain.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    span = len(points) - GRAM + 1
    keys = np.zeros(span, dtype=np.int64)
    for place in range(GRAM):
        keys = (keys << 21) | points[place:place + span]
    found, counts = np.unique(keys, return_counts=True)
    total = np.zeros(DIMENSIONS, dtype=np.float64)
    for at in range(0, len(found), 1024):
        rows = _gram_rows(found[at:at + 1024].tolist())
        total += counts[at:at + 1024].astype(np.float32) @ _vectors[rows].astype(np.float32)
    return total


def language_prototypes(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each non-null label: the sum of its texts' vectors, each scaled to length 100 and rounded.

    Whole numbers add up alike in any order, so reruns agree. The result has one vector of DIMENSIONS
    numbers per label; labels are languages, so their number doesn't grow with the rows.
    """
    rows = labelled.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    parts = rows.mapInPandas(_bundle, "lang string, place int, amount long")
    bundles = cut_lineage(parts.groupBy("lang", "place").agg(F.sum("amount").alias("amount")))
    out: dict[str, np.ndarray] = {}
    for row in bundles.toLocalIterator():
        out.setdefault(row.lang, np.zeros(DIMENSIONS))[row.place] = row.amount
    return {k: out[k] for k in sorted(out) if out[k].any()}


def _bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    take_worker(__name__)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in batch.itertuples(index=False):
            vector = text_vector(text)
            if vector is not None and (length := np.linalg.norm(vector)) > 0:
                own = sums.setdefault(lang, np.zeros(DIMENSIONS, dtype=np.int64))
                own += np.rint(vector * (100 / length)).astype(np.int64)
    _forget()
    for lang, own in sums.items():
        yield pd.DataFrame({"lang": lang, "place": np.arange(DIMENSIONS, dtype=np.int32), "amount": own})


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """The rows with lang_pred and score.

    Score is the cosine with the chosen prototype, 0 if negative. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if there are no prototypes. Ties go to the first
    language by code point. Columns of these two names are replaced.
    """
    names = sorted(prototypes)
    unit = [prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]
    matrix = np.stack(unit, axis=1) if unit else np.zeros((DIMENSIONS, 0))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        take_worker(__name__)
        try:
            for texts in batches:
                yield pd.DataFrame([_nearest(t, names, matrix) for t in texts], columns=["lang_pred", "score"])
        finally:
            _forget()

    found = fresh_name(docs.columns, "_found")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, predict(F.col(f"`{text}`")).alias(found)).select(
        *kept, F.col(f"{found}.lang_pred").alias("lang_pred"), F.col(f"{found}.score").alias("score")
    )


def _nearest(text: str | None, names: list[str], matrix: np.ndarray) -> tuple[str, float]:
    vector = text_vector(text) if names else None
    if vector is None or not vector.any():
        return UNKNOWN, 0.0
    cosines = vector @ matrix / np.linalg.norm(vector)
    best = int(np.argmax(cosines))
    return names[best], float(np.clip(cosines[best], 0.0, 1.0))


def trained_on(docs: DataFrame) -> DataFrame:
    """The rows that may be learnt from: crc32 of the doc_id as text, modulo 4, is not 2."""
    return docs.filter(~held_out())


def held_out():
    """True for rows kept out of learning; a null doc_id is learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
