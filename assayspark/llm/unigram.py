"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton reports every vocabulary piece that ends at a character; a Viterbi pass
carries the best score and its number of pieces from character to character. The rules are the
tokenizer's own: scores add up from the left in double precision, a better score must be greater,
so of equal ones the path whose last piece is longest stays, a character without a piece of its own
costs the lowest score less 10, and counts as one piece per UTF-8 byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import fresh_name

MARK = "▁"
UNKNOWN_COST = 10.0
#: Words whose counts a worker remembers; when full it starts anew. Results don't depend on it.
MEMORY = 500_000
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_workers: dict[str, PieceCounter] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece model file with their scores: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class PieceCounter:
    """Counts the pieces of single words."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_COST
        self.known: dict[str, int] = {}

    def pieces_of(self, word: str) -> int:
        """Pieces of the best segmentation of one word, mark included by the caller."""
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        matches = self.automaton.iter(word)
        following = next(matches, None)
        for end in range(1, n + 1):
            top, pieces, single = None, 0, False
            while following is not None and following[0] == end - 1:
                length, score = following[1]
                reached = best[end - length] + score
                if top is None or reached > top:
                    top, pieces = reached, count[end - length] + 1
                single = single or length == 1
                following = next(matches, None)
            if not single:
                reached = best[end - 1] + self.unknown
                if top is None or reached > top:
                    top, pieces = reached, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            best[end], count[end] = top, pieces
        return count[n]

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and pieces of a text."""
        found = [w for w in _BLANKS.split(text or "") if w]
        known = self.known
        missing = set(found).difference(known)
        if missing and len(known) > MEMORY:
            known.clear()
            missing = set(found)
        for word in missing:
            known[word] = self.pieces_of(MARK + word)
        return len(found), sum(map(known.__getitem__, found))


def counter(path: str) -> PieceCounter:
    """One per worker process and file."""
    if path not in _workers:
        _workers[path] = PieceCounter(vocabulary(path))
    return _workers[path]


def token_counts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The rows with n_words and n_tokens of their whole texts; columns of these names are replaced.

    A word is a run without ASCII white space and begins with the mark of the vocabulary. A null or
    empty text, and one of white space alone, counts 0 and 0. The work follows the rows one by one, without a shuffle.
    """

    @F.pandas_udf("n_words long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = counter(model)
        for texts in batches:
            found = np.array([own.count(t) for t in texts], dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({"n_words": found[:, 0], "n_tokens": found[:, 1]})

    own = fresh_name(docs.columns, "_found")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "n_tokens")]
    return docs.select(*kept, count(F.col(f"`{text}`")).alias(own)).select(
        *kept, F.col(f"{own}.n_words").alias("n_words"), F.col(f"{own}.n_tokens").alias("n_tokens")
    )
