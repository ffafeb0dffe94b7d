"""The licence scan against brute force over all places of all passages."""

from __future__ import annotations

import random
import re

import pytest

from assayspark.llm.licenses import BASE_PHRASES, PASSAGES, Passage, license_scan, word_list

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, passages, phrases, percent):
    own, found = words(text), []
    for phrase, label in phrases.items():
        p = words(phrase)
        found += [(label, k, len(p), 1.0, True) for k in range(len(own) - len(p) + 1) if own[k:k + len(p)] == p]
    for label, passage, key in passages:
        p, q = words(passage), words(key)
        at = next(k for k in range(len(p)) if p[k:k + len(q)] == q)
        for k in range(len(own) - len(p) + 1):
            same = sum(a == b for a, b in zip(own[k:], p, strict=False))
            if 100 * same >= percent * len(p) and own[k + at:k + at + len(q)] == q:
                found.append((label, k, len(p), same / len(p), False))
    based = [f[1] for f in found if f[4]]
    places = sorted(((f[1], f[0], f[2], f[3]) for f in found), key=lambda f: f[:3])
    return (len(own), len(based), min(based, default=None), max(based, default=None),
            ",".join(sorted({f[0] for f in found if f[4]})), ",".join(sorted({f[0] for f in found})),
            max((f[3] for f in found), default=0.0), places)


def cases():
    draw, texts = random.Random(5), []
    vocabulary = sorted({w for p in PASSAGES for w in words(p.text)})
    for passage in [*PASSAGES, *(Passage(b, a, a) for a, b in BASE_PHRASES.items())]:
        for changes in (0, 0, 1, 2, 4, 9):
            own = re.findall(r"\S+", passage.text)
            for _ in range(changes):
                k = draw.randrange(len(own)) if own else 0
                own[k:k + 1] = draw.choice([["x"], [draw.choice(vocabulary)], [], [*own[k:k + 1], "y"]])
            before, after = (draw.choices([*vocabulary, "tree", "é", "Straße"], k=draw.randrange(6)) for _ in range(2))
            text = draw.choice([" ", "\n// ", " * "]).join(before + own + after)
            texts.append(draw.choice([text, text.upper(), text * 3]))
    texts += [None, "", " \n", "cc", "apache license version 2 apache license version 2apache license version 2.0", "CC-BY-NC " * 900,
              "under the mit license " * 400 + "ſ", "CC BY\x00NC and CC BY-NC", "the " * 5000 + "MIT License"]
    return texts


def test_license_scan(spark, documents):
    texts = cases()
    docs = documents([*texts, texts[3]], [*range(len(texts) - 1), None, 3]).withColumnRenamed("node", "labels")
    found = license_scan(docs).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        text = texts[-1] if r.doc_id is None else texts[r.doc_id]
        own = brute(text, PASSAGES, BASE_PHRASES, 80)
        places = [(p["first"], p["label"], p["n_words"], p["share"]) for p in r.places]
        assert (*tuple(r)[1:-1], places) == own, text


@pytest.mark.parametrize("percent", [40, 100])
def test_other_passages(documents, percent):
    passages = [Passage("one", "a b a a c a b", "c a"), Passage("two", "the " * 9 + "end", "the end"), Passage("short", "solo", "solo")]
    draw = random.Random(percent)
    texts = [" ".join(draw.choices(["a", "b", "c", "the", "end", "solo"], weights=[5, 3, 2, 6, 1, 1], k=40)) for _ in range(40)]
    for r in license_scan(documents(texts), passages, {"a b": "x", "solo": "short"}, percent).collect():
        own = brute(texts[r.doc_id], passages, {"a b": "x", "solo": "short"}, percent)
        assert (*tuple(r)[1:-1], [(p["first"], p["label"], p["n_words"], p["share"]) for p in r.places]) == own


def test_no_documents(documents):
    assert license_scan(documents([])).collect() == []


def test_words_and_keys():
    assert word_list("MIT-License, 2.0 Ünï_x y") == words("MIT-License, 2.0 Ünï_x y")
    with pytest.raises(ValueError, match="key phrase"):
        license_scan.__globals__["Index"]([Passage("a", "b c", "d")], {}, 80)
