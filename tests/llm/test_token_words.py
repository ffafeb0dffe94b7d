"""Ids put together word by word against the tokenizer on whole texts."""

import public_tokenizers
import pyarrow as pa
from assayspark.llm.tokens import WordCoder

ODD = [
    "", " ", "H̱ x", "a.\n\n B, <unk> <UNK>. <|endoftext|>.", "\x0b a\x0cb.\x85c d. É. ß, ñ.́ a.́ ́.",
    "it's. I'S, İ. KK. 12. a1. 1a, x..., y., .", "a.a.a.", "Å. a​. あ.  z. ", "x\x00y. \x1c q.\x1d r",
    "ﬁ.", "e.̧ f", "×. ÷, क़. word word. Word, WORD",
]


def test_odd_words():
    own = WordCoder(public_tokenizers.path("word_bpe_49k.json"))
    found, lens = own.ids(pa.array(ODD))
    at = 0
    for text, n in zip(ODD, lens.tolist(), strict=True):
        assert found[at:at + n].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, text
        at += n
    assert at == len(found)


def test_selectors_hold_the_most_values():
    """Each place gets the selector of most values that fit from there on; the end of a block is filled with zeros."""
    import numpy as np

    from assayspark.llm import simple8b

    rng = np.random.default_rng(8)
    values = (rng.integers(0, 1 << 40, 700) >> rng.integers(0, 41, 700)).astype(np.uint64)
    values[100:420], values[-30:], values[7] = 0, 1, np.uint64(1 << 61)
    found = simple8b._selectors_at(values).tolist()
    for at, selector in enumerate(found):
        fitting = [s for s, (count, bits) in simple8b.SELECTORS.items() if (values[at:at + count] < np.uint64(1 << bits)).all()]
        zeros = len(values) - at >= simple8b.ZEROS and not values[at:at + simple8b.ZEROS].any()
        assert selector == (0 if zeros else min(fitting, default=1))
    narrow = np.arange(1, 200, dtype=np.uint64) % 8
    assert simple8b._runs(narrow < 7, 7).tolist() == [bool((narrow[k:k + 7] < 7).all()) for k in range(193)]
    assert simple8b.decode(simple8b.encode(values)).tolist() == values.tolist()
