"""What a Python worker holds: the pipeline's stages share its memory with the tasks before them."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from assayspark.llm import jaccard, langid, tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def batch(texts):
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array([False] * n), pa.array(range(n), pa.int64()), pa.array(texts), pa.array([0] * n, pa.int32())],
        names=["unnamed", "doc_id", "text", "shard"],
    )


def test_a_full_memory_of_grams_is_small():
    """A byte a component, and the sums are those of wider numbers."""
    letters = [chr(97 + k) for k in range(26)] + [chr(0xE0 + k) for k in range(2)]
    text = " ".join(a + b + c for a in letters for b in letters for c in letters[:18])
    found = langid.text_vector(text)
    try:
        assert len(langid._rows) > langid.MEMORY // 2
        assert langid._vectors.nbytes <= langid.MEMORY * langid.DIMENSIONS
    finally:
        langid._forget()
    wide = {a: langid.letter_vector(a).astype(np.float64) for a in {*letters, " "}}
    plain, whole = f" {text} ", np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(plain, plain[1:], plain[2:], strict=False):
        whole += np.roll(wide[a], 2) * np.roll(wide[b], 1) * wide[c]
    assert (found == whole).all()


def test_token_writer_takes_a_batch_in_small_parts():
    """The arrays of the words of a batch are not there all at once; ids are those of the texts one by one."""
    draw = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(500)])
    texts = [" ".join(words[draw.integers(0, 500, 300)]) for _ in range(3000)]
    given = batch(texts)
    write = tokens._writer(TOKENIZER, 1)
    list(write(iter([given.slice(0, 10)])))
    tracemalloc.start()
    try:
        lens = [n for block in write(iter([given])) for n in block["doc_lens"][0].as_py()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6, peak
    assert lens[::500] == [len(tokens.coder(TOKENIZER).tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts[::500]]


def test_remembered_words_go_when_another_operator_begins():
    for other in (langid._bundle, jaccard._describe(5), jaccard._index(5, 80, np.zeros(0, np.uint64))):
        tokens._workers.clear()
        list(tokens._writer(TOKENIZER, 1)(iter([batch(["some words", "more words"])])))
        list(tokens._writer(TOKENIZER, 1)(iter([batch(["other words"])])))
        assert len(tokens._workers[TOKENIZER].store) == 4  # some, more, words, other
        list(other(iter([])))
        assert not tokens._workers
