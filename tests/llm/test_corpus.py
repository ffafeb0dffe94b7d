"""The corpus operators against brute force, on small cases with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import html
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from assayspark.llm import anchors, bytespans, jaccard, langid, simple8b, unigram
from assayspark.llm.bytespans import strip_repeats
from assayspark.llm.common import components
from assayspark.llm.decontaminate import leaked_documents, without_leaks
from assayspark.llm.jaccard import jaccard_groups, overlaps_join
from assayspark.llm.lines import delete_repeated_runs
from assayspark.llm.lyndon import suffix_array
from assayspark.llm.maintext import extract_main_text, main_text
from assayspark.llm.mixing import mix, repeat_rows
from assayspark.llm.tokens import document_digests, read_token_blocks, write_token_blocks
from assayspark.llm.unigram import token_counts
from assayspark.llm.vectors import near_vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(words))


def lowest(nodes, links):
    group = {n: n for n in nodes}

    def top(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        group[y] = x
    return {n: top(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in (7000, 8000, -5)] + [(50, 50), (60, 61), (61, 60)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert found == lowest(nodes, [e for e in edges if e[0] != e[1]])


def brute_lines(rows, run):
    lines = {i: t.split("\n") for i, t in rows if t is not None and i is not None}
    first, out = {}, {}
    for i in sorted(lines):
        for at in range(max(len(lines[i]) - run, 0) + 1):
            first.setdefault(tuple(lines[i][at:at + run]), (i, at))
    for i, own in lines.items():
        gone = set()
        for at in range(max(len(own) - run, 0) + 1):
            if first[tuple(own[at:at + run])] < (i, at):
                gone |= set(range(at, min(at + run, len(own))))
        out[i] = (len(own), len(gone), sum(g - 1 not in gone for g in gone),
                  "\n".join(x for k, x in enumerate(own) if k not in gone))
    return out


def test_line_dedup(documents):
    draw = random.Random(4)
    pool = ["", "alpha", "beta beta", "gamma", "delta", "é"]
    texts = ["\n".join(draw.choices(pool, k=draw.randint(1, 30))) for _ in range(40)] + ["", "alpha", "alpha", "a\nb\nc" * 500]
    rows = list(enumerate(texts)) + [(900, None), (None, texts[0])]
    docs = documents([t for _, t in rows], [i for i, _ in rows])
    found = delete_repeated_runs(docs).collect()
    expected = brute_lines(rows, 3)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.lines_kept == r.text and r.lines_removed == 0
        elif r.text is None:
            assert (r.lines_total, r.lines_removed, r.lines_kept) == (0, 0, None)
        else:
            assert (r.lines_total, r.lines_removed, r.runs_removed, r.lines_kept) == expected[r.doc_id]
    assert {"n", "node", "rank"} <= set(found[0].asDict())


def test_line_dedup_of_few_long_lines(documents):
    long, half, other = prose(31, 60), prose(32, 30), prose(33, 30)
    texts = ["\n".join(["a", long, "b", half, other, "c"]), f"x\n{long}\ny", long, f"{half}\n{other}", f"p\n{half}\n{other}\nq",
             f"r\n{half}\ns", "a\nb"]
    found = {r.doc_id: r.lines_kept for r in delete_repeated_runs(documents(texts)).collect()}
    assert found == {0: texts[0], 1: "x\ny", 2: "", 3: "", 4: "p\nq", 5: texts[5], 6: texts[6]}


def test_near_vectors(spark):
    draw = np.random.default_rng(3)
    base = draw.standard_normal((30, 16))
    rows = [(k, (base[k % 30] + draw.normal(0, 0.05 * (k % 4), 16)).tolist(), k % 2 if k % 30 else None) for k in range(150)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] + [1.0] * 15, 1), (503, [None] + [1.0] * 15, 1),
             (504, [], 1), (505, [1.0, 2.0], 1), (None, [1.0] * 16, 1), (506, rows[1][1], 1), (506, rows[1][1], 1)]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(found) == len(rows)
    usable = [(i, np.array(v), c) for i, v, c in rows[:150] if c is not None] + [(506, np.array(rows[1][1]), 1)]
    links = [
        (i, j) for k, (i, v, c) in enumerate(usable) for j, w, d in usable[:k]
        if c == d and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98
    ]
    groups = lowest([i for i, _, _ in usable], links)
    assert links
    for r in found:
        if r.vec_id is not None:
            assert r.component_id == groups.get(r.vec_id, r.vec_id)
            assert r.kept == (r.component_id == r.vec_id)
            own = r.vec_id if r.vec_id != 506 else 1
            copies = 2 * (r.vec_id in (1, 506))
            expected = Counter(i for link in links for i in link)[own] + copies // 2
            assert r.n_links == (expected + sum(own in link and 1 in link for link in links) * (own != 1) if r.vec_id in groups else 0), r


def test_near_vectors_of_several_lengths(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.01]), (3, [float(k) for k in range(1, 17)]), (4, [k + 0.01 for k in range(1, 17)]), (5, [1.0])]
    found = near_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def brute_jaccard(rows, size, percent):
    sets, links = {}, []
    for i, t in rows:
        found = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(found[k:k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links.append((i, j))
    return sets, links


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard_join(documents, size, percent):
    draw, texts = random.Random(size), []
    for group in range(12):
        own = prose(group, draw.choice([3, 8, 20, 60, 200])).split()
        for _ in range(8):
            changed = list(own)
            for _ in range(draw.randint(0, 1 + len(own) // 20)):
                changed[draw.randrange(len(changed))] = "x" + str(draw.random())
            texts.append(" ".join(changed).upper() if draw.random() < 0.2 else "\t ".join(changed))
    texts += ["", " \n", None, "one", "ONE", "one two", prose(5, 8000)]
    rows = list(enumerate(texts))
    sets, links = brute_jaccard(rows, size, percent)
    docs = documents(texts + ["one", texts[0]], [*range(len(texts)), None, 0])
    found = jaccard_groups(docs, size, percent).collect()
    groups, count = lowest(sets, links), Counter(i for link in links for i in link)
    assert len(found) == len(rows) + 2
    for r in found:
        if r.doc_id is None:
            assert (r.n_shingles, r.n_links, r.component_id) == (1, 0, None)
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), groups[r.doc_id])
            # Document 0 stands there twice: its own copy and its neighbours have one link more.
            near = {0}.union(i for link in links if 0 in link for i in link)
            assert r.n_links == count[r.doc_id] + (r.doc_id in near)


def test_repeated_rows_count_once_each(documents):
    a, b = prose(3, 40), prose(3, 39) + " end"
    found = jaccard_groups(documents([a, a, b, b, a], [1, 1, 2, 3, None]), 3, 90).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.component_id) for r in found) == [(0, 0, None), (1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 3, 1)]


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_similar_sets_share_one_of_few_keys(percent):
    draw, levels = np.random.default_rng(percent), jaccard._levels(percent)
    for size in [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 32, 33, 60, 64, 65, 130, 300, 346, 513, 1100] * 4:
        most = jaccard._most_apart(size, percent)
        pool = np.unique(draw.integers(1, 1 << 62, size + most + 20).astype(np.uint64))
        draw.shuffle(pool)
        often = pool[draw.random(len(pool)) < draw.choice([0, 0.3, 0.9])]
        one, spare = pool[:size], pool[size:]
        lost = int(draw.integers(0, most + 1))
        for gone, new in [(0, most), (lost // 2, lost - lost // 2), (lost, 0)]:
            two = np.concatenate([one[gone:], spare[:new]])
            keys = []
            for own in (np.sort(one), np.sort(two)):
                keys.append(jaccard._block_keys(own, ~np.isin(own, often), percent, levels))
                met = np.searchsorted(levels, len(own)) - np.searchsorted(levels, -(-len(own) * percent // 100)) + 1
                # A set gives one block more than can differ, twice that where its rare shingles fill too few.
                fills = percent >= 80 and size >= 60 and not len(often)
                assert len(keys[-1]) <= met * (jaccard._most_apart(len(own), percent) + 1) * (1 if fills else 2)
            if 100 * (size - gone) >= percent * (size + new):
                assert np.intersect1d(*keys).size


def test_overlaps_across_two_portions():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, draw.integers(5, 50))) for _ in range(60)]
    side = np.arange(60) % 2
    a, b = overlaps_join(sets, side, 40)
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    expected = {
        (i, j) for i in range(60) for j in range(i + 1, 60) if side[i] != side[j]
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))
    }
    assert found == expected


def test_lists_are_read_from_the_least_set():
    entries = np.array([0, 1, 4, 5, 7, 9])  # token 0 in sets 0, 1 and 4, token 1 in 0, 2 and 4
    assert jaccard._positions(entries, np.array([0, 1]), 2, 5).tolist() == [2, 4, 5]
    assert jaccard._positions(entries, np.array([1]), 0, 5).tolist() == [3, 4, 5]


def test_portions_meet_once(spark):
    # Two bands of three and two portions: every two portions of one band, and of both, have one meeting; sides tell them apart.
    rows = [(4, 3, 2, 0, k) for k in range(3)] + [(5, 2, 0, 3, k) for k in range(2)]
    df = spark.createDataFrame(rows, "band int, own int, up int, down int, drawn int")
    found = [(r, [tuple(m) for m in r.meet]) for r in df.withColumn("meet", jaccard.meetings(F.col("drawn"))).collect()]
    for k, (row, own) in enumerate(found):
        assert len({m[:4] for m in own}) == len(own) == 5
        for other, theirs in found[:k]:
            shared = {m[:4] for m in own} & {m[:4] for m in theirs}
            assert len(shared) == 1
            sides = {m[4] for m in [*own, *theirs] if m[:4] in shared}
            assert sides == {0, 1}
        assert sum(m[4] == 2 for m in own) == 1
        assert all(m[4] == int(m[0] != row.band) for m in own if m[1])


@pytest.mark.parametrize("portion", [150, 2000])
def test_groups_in_bands_and_portions(documents, monkeypatch, portion):
    monkeypatch.setattr(jaccard, "PORTION", portion)
    draw, base, texts = random.Random(8), prose(77, 60).split(), []
    for _ in range(60):
        own = base[:draw.randint(40, 60)]
        own[draw.randrange(len(own))] = "x" + str(draw.randint(0, 9))
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    sets, links = brute_jaccard(rows, 2, 80)
    groups, count = lowest(sets, links), Counter(i for link in links for i in link)
    for r in jaccard_groups(documents(texts), 2, 80).collect():
        assert (r.n_links, r.component_id) == (count[r.doc_id], groups[r.doc_id])


def test_covers_are_settled_many_at_a_time():
    draw = np.random.default_rng(5)
    rows = pd.DataFrame({c: draw.integers(0, n, 30_000) for c, n in [("anchor", 4000), ("cover", 3), ("doc", 50), ("place", 1 << 20)]})
    rows = rows.sort_values(["anchor", "cover", "doc", "place"], ignore_index=True)
    once = pd.concat(bytespans._settle(iter([rows])))
    parts = list(bytespans._settle(rows.iloc[k:k + 2048] for k in range(0, len(rows), 2048)))
    assert sum(len(p) > 0 for p in parts) <= 8
    columns = list(once.columns)
    assert pd.concat(parts).sort_values(columns, ignore_index=True).equals(once.sort_values(columns, ignore_index=True))
    leader = rows.groupby(["anchor", "cover"])["doc"].transform("min")
    assert (once["kind"] == bytespans.COVERED).sum() == (rows["doc"] > leader).sum()


def test_joined_texts_have_their_own_anchors():
    draw = random.Random(4)
    texts = [bytes(draw.choices(b"ab c", k=draw.choice([0, 1, 49, 50, 51, 90, 700]))) for _ in range(80)]
    text, *found = anchors.joined_anchors(texts)
    for k, own in enumerate(texts):
        alone = list(anchors.text_anchors(np.frombuffer(own, dtype=np.uint8)))
        for at, column in enumerate(found):
            assert column[text == k].tolist() == [x for part in alone for x in part[at].tolist()]


def test_simple8b_round_trip():
    draw = np.random.default_rng(0)
    for values in ([], [0] * 1000, [1] * 61, draw.integers(0, 50_000, 9999), [2**64 - 1, 5, 2**60, 2**60 - 1, 0], [2**31] * 7):
        array = np.array(values, dtype=np.uint64)
        assert (simple8b.decode(simple8b.encode(array)) == array).all()


def test_token_blocks(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = "a b <|endoftext|>x Don't İstanbul ΑΣ. éa x...y\x1cz q 12,5 I'll U.S.A., ²a. ﬁn"
    texts = [prose(1, 300), "", None, "Hello, hello.", odd, prose(2, 40_000), "Hello, hello."]
    ids = [9, 3, 4, -7, 2**60 + 1, 5, None]
    write_token_blocks(documents(texts, ids), str(tmp_path / "t"), path)
    found = document_digests(read_token_blocks(spark, str(tmp_path / "t"))).collect()
    start, expected = 0, {}
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0)):
        own = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected[i] = (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected


def test_token_counts_follow_the_tokenizer(documents):
    from tokenizers import Tokenizer, models

    pieces = unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    exact = Tokenizer(models.Unigram([("<unk>", min(s for _, s in pieces)), *pieces], 0, False))
    texts = ["Hello world", "", None, " \n\t", prose(3, 500), "naïve 中文\U0001f600字 xx", "a" * 3000]
    found = {r.doc_id: (r.n_words, r.n_tokens) for r in
             token_counts(documents(texts), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    for i, text in enumerate(texts):
        own = WORD.findall(text or "")
        total = 0
        for word in own:
            marked = unigram.MARK + word
            coded = exact.encode(marked, add_special_tokens=False)
            total += sum(1 if k else len(marked[a:b].encode()) for k, (a, b) in zip(coded.ids, coded.offsets, strict=True))
        assert found[i] == (len(own), total)


def test_unigram_ties_keep_the_longest_last_piece():
    counter = unigram.PieceCounter([("a", -1.0), ("aa", -2.0), ("aaa", -3.0)])
    assert [counter.pieces_of("a" * n) for n in (1, 2, 3, 4)] == [1, 1, 1, 2]


def test_decontamination(spark, documents):
    items = [(1, "Alice has 3 apples and gives 2 apples to Bob before they walk 5 km home."), (2, prose(7, 30)),
             (3, prose(8, 4)), (4, None), (5, ""), (None, prose(10, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    renamed = "Carol has 7 apples and gives 4 apples to Dave before they walk 9 km home."
    muddled = "Carol has 7 apples and gives 7 apples to Carol before they walk 9 km home."
    texts = [prose(20, 50) + " " + items[1][1] + " " + prose(21, 50), renamed, muddled, items[2][1], prose(22, 300), None, "",
             " ".join(items[1][1].split()[:12]), items[5][1], items[1][1] * 1, prose(23, 60) + ", " + items[1][1].upper()]
    docs = documents(texts)
    found = {(r.doc_id, r.item_id) for r in leaked_documents(docs, bench).collect()}
    assert {(0, 2), (1, 1), (3, 3), (8, None), (9, 2)} <= found
    assert not {d for d, _ in found} & {2, 4, 5, 6, 7}
    kept = {r.doc_id for r in without_leaks(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in found}
    assert leaked_documents(docs.limit(0), bench).count() == 0
    assert leaked_documents(docs, bench.limit(0)).count() == 0


def test_decontamination_of_copies_with_small_changes(spark, documents):
    long = "The first box is red and the second one " + prose(41, 51)
    bench = spark.createDataFrame([(1, long), (2, "Alice has 3 apples and " + prose(42, 40))], "item_id long, text string")
    own = long.split()
    muddled = long.replace("The first", "An first")
    texts = [muddled, long.upper(), prose(43, 9) + " " + " ".join(own[:45]), " ".join(own[:25]), prose(44, 60),
             " ".join(own[5:34]), " ".join(own[5:35])]
    found = {(r.doc_id, r.item_id) for r in leaked_documents(documents(texts), bench).collect()}
    assert found == {(0, 1), (1, 1), (2, 1), (6, 1)}


def brute_leaks(texts, items, window=5, percent=80, excerpt=30):
    """Every alignment of every text with every item, window by window."""
    from assayspark.llm.decontaminate import PUNCTUATION, UNITS

    def split(text):
        return [w for w in (x.strip(PUNCTUATION) for x in WORD.findall(text or "")) if w]

    def template(word):
        if "0" <= word[0] <= "9":
            return 1
        return 2 if word.lower() in UNITS else 3 if word[0] != word[0].lower() else word.lower()

    found = set()
    for d, text in enumerate(texts):
        own = split(text)
        for item_id, item in items:
            words = split(item)
            n = max(1, len(words) - window + 1)
            if not words:
                continue
            spoken = {k for k in range(n) if any(isinstance(template(w), str) for w in words[k:k + window])}
            literal = spoken or set(range(n))
            counted, longest = set(), 0
            for shift in range(-len(words), len(own) + 1):
                pairs = [(w.lower(), own[k + shift].lower() if 0 <= k + shift < len(own) else None) for k, w in enumerate(words)]

                def windows(test):
                    return [k for k in range(n) if 0 <= k + shift and k + shift + len(words[k:k + window]) <= len(own)
                            and (len(words) >= window or len(own) == len(words)) and test(k)]

                same = windows(lambda k: all(a == b for a, b in pairs[k:k + window]))
                alike = windows(lambda k: k in spoken and [template(w) for w in words[k:k + window]]
                                == [template(w) for w in own[k + shift:k + shift + window]][:len(words)])
                other, kept = sorted(set(alike) - set(same)), []
                runs = {}
                for k in other:
                    runs.setdefault(sum(x < k for x in same), []).append(k)
                for run in runs.values():
                    slots = {p for k in run for p in pairs[k:k + window]}
                    if len({a for a, _ in slots}) == len(slots) == len({b for _, b in slots}):
                        kept += run
                counted |= (set(same) | set(kept)) & literal
                best = 0
                for a, b in pairs:
                    best = best + 1 if a == b else 0
                    longest = max(longest, best if best >= min(window, len(words)) and same else 0)
            if 100 * len(counted) >= percent * len(literal) or longest >= excerpt:
                found.add((d, item_id, len(literal), len(counted)))
    return found


def test_decontamination_against_every_alignment(spark, documents):
    draw = random.Random(12)
    names, plain = ["Anna", "Ben", "Cleo", "Dan", "Eve"], ["box", "red", "gives", "to", "the", "km", "7", "31", "of"]

    def text(n, share):
        return [draw.choice(names) if draw.random() < share else draw.choice(plain) for _ in range(n)]

    items = [(k, " ".join(text(draw.choice([3, 8, 14, 45]), draw.choice([0, 0.3, 1])))) for k in range(12)]
    texts = []
    for _, item in items:
        for _ in range(4):
            own, swap = item.split(), dict(zip(names, draw.sample(names, 5), strict=True))
            if draw.random() < 0.6:
                own = [swap.get(w, w) for w in own]
            if draw.random() < 0.5:
                own[draw.randrange(len(own))] = draw.choice(names + plain)
            if draw.random() < 0.3:
                own = own[:draw.randint(1, len(own))]
            texts.append(" ".join(text(draw.choice([0, 6]), 0.4) + own + text(draw.choice([0, 6]), 0.4)))
    texts += [texts[0].upper(), "", None]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.n_windows, r.n_found) for r in leaked_documents(documents(texts), bench).collect()}
    assert found == brute_leaks(texts, items)


def test_lists_of_other_names_hold_nothing(spark, documents):
    def listed(start, n):
        return " ".join("N" + "abcdefghij"[k % 10] + "abcdefghij"[k // 10 % 10] + "abcdefghij"[k // 100 % 10] + "x" * (k // 1000)
                        for k in range(start, start + n))

    bench = spark.createDataFrame([(k, listed(40 * k, 40)) for k in range(20)], "item_id long, text string")
    texts = [listed(2000 + 400 * k, 400) for k in range(200)] + [listed(1990, 20) + " " + listed(80, 40)]
    assert {(r.doc_id, r.item_id) for r in leaked_documents(documents(texts), bench).collect()} == {(200, 2)}


def brute_bytes(rows):
    data = sorted((i, (t or "").encode()) for i, t in rows)
    first, out = {}, {}
    for i, t in data:
        for at in range(len(t) - 49):
            first.setdefault(t[at:at + 50], i)
    for i, t in data:
        gone = bytearray(len(t))
        for at in range(len(t) - 49):
            if first[t[at:at + 50]] < i:
                gone[at:at + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out[i] = (len(t), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])),
                  hashlib.sha256(kept).hexdigest())
    return out


def byte_texts():
    draw, shared = random.Random(9), [prose(100 + k, 30) for k in range(4)]
    texts = []
    for k in range(90):
        own = prose(k, draw.randint(1, 40))
        cut = draw.choice(shared)
        a, b = sorted(draw.sample(range(len(cut)), 2))
        texts.append(own + cut[a:b] + prose(k + 500, 5))
    return texts + ["", None, "é" * 200, "é" * 120, "ab" * 300, "ab" * 200, shared[0], shared[0], prose(1, 9)[:49]]


def test_byte_dedup(documents):
    texts = byte_texts()
    expected = brute_bytes(enumerate(texts))
    docs = documents([*texts, texts[0]], [*range(len(texts)), None])
    found = strip_repeats(docs).withColumn("sha", F.sha2("kept", 256)).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.sha) == expected[r.doc_id]


def test_covers_that_share_their_low_bits_differ():
    import pandas as pd

    anchor, cover = np.full(2, 7, dtype=np.uint64), np.array([5, 5 + (1 << 32)], dtype=np.uint64)
    rows = bytespans._anchor_rows([(anchor, cover, np.array([1, 2]), np.zeros(2, dtype=np.int64))])
    settled = pd.concat(bytespans._settle(iter([rows])))
    assert not (settled.kind == bytespans.COVERED).any()


def test_cut_anchors_are_matched_by_their_windows(monkeypatch):
    """With blocks of four covers nearly every anchor is cut; spans and windows together still find all."""
    import pandas as pd

    monkeypatch.setattr(bytespans, "BLOCK", 4)
    texts = [t.encode() for t in byte_texts() if t]
    rows = pd.concat(bytespans._anchors(iter([pd.DataFrame({"doc": range(len(texts)), "text": texts})])))
    rows = rows.sort_values(["anchor", "cover", "doc", "place"], ignore_index=True)
    settled = pd.concat(bytespans._settle(iter([rows[k:k + 37] for k in range(0, len(rows), 37)])))
    first = settled[settled.kind == bytespans.FIRST_RUN]
    opened = pd.concat([settled[settled.kind == bytespans.OPEN], first])
    gone = [bytearray(len(t)) for t in texts]
    for r in settled[settled.kind == bytespans.COVERED].itertuples():
        gone[r.doc][r.place >> 12:(r.place >> 12) + (r.place & 63) + 50] = b"\1" * ((r.place & 63) + 50)
    groups = [(d, g["anchor"].to_numpy(), g["place"].to_numpy()) for d, g in opened.groupby("doc")]
    frame = pd.DataFrame([(d, texts[d], a, p) for d, a, p in groups], columns=["doc", "text", "anchor", "place"])
    pieces = pd.concat(bytespans._contexts(iter([frame]))).sort_values(["anchor", "piece"])
    found = pd.concat(bytespans._edges(iter([pieces[k:k + 11] for k in range(0, len(pieces), 11)])))
    windows = found[found.kind == bytespans.WINDOW]
    least = windows.groupby(["key", "check"])["doc"].transform("min")
    assert len(windows)
    for r in pd.concat([found[found.kind == bytespans.SPAN], windows[windows.doc > least]]).itertuples():
        gone[r.doc][r.start:r.stop] = b"\1" * (r.stop - r.start)
    expected = brute_bytes((k, t.decode()) for k, t in enumerate(texts))
    assert [sum(g) for g in gone] == [expected[k][1] for k in range(len(texts))]


def test_suffix_array():
    draw = random.Random(1)
    for _ in range(200):
        text = bytes(draw.choices(b"ab\0", k=draw.randint(0, 50))) * draw.choice([1, 1, 2])
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


PAGE = """<html><head><title>T</title><style>p {margin:0}</style><script>var a="</p>";</script></head><body><nav><ul><li>Menu</li></ul></nav>
<header><p>Site</p></header><div class="cookie-notice">We use cookies</div>{}<aside>Side</aside><form><input><p>Sign up</p></form>
<div id="comments"><p>A reader's long comment, {}</p></div><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    body = "<h1>Head&amp;line</h1><p>One <b>bo</b>ld\n  text.<br>Two<p>Thr&eacute;e&nbsp;x</p><div class='ad'>Buy</div><p>.</p>"
    wanted = "Head&line One bold text. Two Thrée x ."
    pages = [PAGE.replace("{}", x, 1).replace("{}", "word " * 4) for x in (f"<article>{body}</article>", f"<div>{body}</div>")]
    assert main_text(pages[0]) == wanted
    assert "Menu" not in main_text(pages[1]) and "comment" not in main_text(pages[1]) and "One bold text." in main_text(pages[1])
    assert main_text(pages[0][:pages[0].index("Two") + 3]) == "Head&line One bold text. Two"
    rows = [(1, "u", pages[0], "old"), (2, None, None, ""), (3, "u", "", ""), (4, "u", "no markup at all", ""), (4, "u", "<p", "")]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.text for r in found] == [wanted, "", "", "no markup at all", ""]
    assert all(r.n_chars == len(r.text) for r in found)


def test_main_text_without_an_article():
    long, ad = "word " * 60 + "end.", "<div class=ad>Buy</div>"
    body = f"<h1>Title</h1>{ad}<p>{long}</p>{ad}<p>Short.</p>{ad}<p>{long}</p>{ad}<p>So.</p><p>.</p>"
    wanted = f"Title {long} Short. {long} So. ."
    assert main_text(PAGE.replace("{}", f"<div>{body}</div>", 1).replace("{}", "word " * 4)) == wanted


def test_dropped_elements_without_end_tag():
    for body in ("<p>One<p class=ad>Buy <b>now</b><p>Two", "<div><p>One</p><div><p class=ad>Buy</div><p>Two</p></div>",
                 "One<ul><li class=share>Share<ul><li>x</ul><li>Two</ul>", "<ul><li class=share>Share</li><li>One</ul>Two",
                 "<table><tr><td>One<td class=ad>Buy<tr><td>Two</table>", "<table><tr><td>One<tr class=ad><td>Buy</table>Two",
                 "<p>One<dl><dt class=ad>Buy<dd class=ad>x<p>y</dl>Two", "One<p class=ad>Buy</p>Two"):
        assert main_text(f"<body>{body}</body>") == main_text(f"<article>{body}</article>") == "One Two"


WORDS = " ".join(f"word{k}" for k in range(60))


@pytest.mark.parametrize(("page", "wanted"), [
    (f'<div class="layout no-comments"><article><p>{WORDS}</p></article></div>', WORDS),
    (f'<div class="content has-sidebar"><p>{WORDS}</p></div>', WORDS),
    (f'<div class="post social-share"><p>{WORDS}</p></div>', WORDS),
    (f'<div id="sidebar"><main><p>{WORDS}</p></main></div><div class="sidebar">x y z</div>', WORDS),
    (f'<article><p>{WORDS}</p><section id="related-work"><p>Others did this.</p></section></article>', WORDS + " Others did this."),
    (f'<article><p>{WORDS}</p><div class="related-posts"><a href="/a">One</a> <a href="/b">Two</a></div></article>', WORDS),
    (f'<article><p>{WORDS}</p><div class="post-comments"><p>Nice.</p></div></article>', WORDS),
    (f'<article><p>{WORDS}</p></article><article><h2>Read next</h2><p>Short one.</p></article>', WORDS),
    (f'<article><p>{WORDS}</p></article><article><p>{WORDS} more</p></article>', f"{WORDS} {WORDS} more"),
    (f'<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul><h1>Title</h1><p>{WORDS}</p><p>End.</p><p>© 2024 Us</p>',
     f"Title {WORDS} End."),
    (f'<body class="nav"><p>{WORDS}</p><div class="site-footer">imprint</div></body>', WORDS),
    (f'<div class="nav"><div class="menu"><div class="ad"><p>{WORDS}', WORDS),
    ('<div class="ad">only an advert</div>', "only an advert"),
    (f'<article><p>{"very long " * 30000}</p></article>', ("very long " * 30000).strip()),
])
def test_main_text_within_wrappers(page, wanted):
    assert main_text(page) == wanted


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in pages.collect():
        article = r.html.split("<article>", 1)[1].split("</article>")[0]
        assert main_text(r.html) == " ".join(" ".join(html.unescape(x) for x in re.split(r"<[^>]*>", article)).split())


def brute_profile(text):
    plain = re.sub(r"[\W\d_]+", " ", text or "").strip().lower()
    if not plain:
        return None
    total = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(f" {plain} ", f" {plain} "[1:], f" {plain} "[2:], strict=False):
        total += np.roll(langid.letter_vector(a), 2) * np.roll(langid.letter_vector(b), 1) * langid.letter_vector(c)
    return total


def test_language_id_against_plain_profiles(documents):
    draw = random.Random(2)

    def text(letters, n):
        return " ".join("".join(draw.choices(letters, k=draw.randint(1, 6))) for _ in range(n))

    labelled = [(text("abcde", 20), "x"), (text("efgh", 15), "y"), (text("ABcdé", 9), "x"), ("zz zz", "n"), ("zz zz", "m"), (None, "y"),
                ("", "x"), ("12 34", "q"), (text("efgh", 5), None)]
    texts = [text("abcde", 8), text("efgh", 8), "zz", None, " \t", "1_2", "a", "É", text("abcdefgh", 60000), "日本語 text", labelled[0][0]]
    sums = {}
    for own, lang in labelled:
        vector = brute_profile(own)
        if lang is not None and vector is not None:
            sums[lang] = sums.get(lang, 0) + np.rint(vector * (100 / np.linalg.norm(vector)))
    train = documents([t for t, _ in labelled], langs=[lang for _, lang in labelled])
    prototypes = langid.language_prototypes(train)
    assert sorted(prototypes) == sorted(sums) == ["m", "n", "x", "y"]
    assert all((prototypes[k] == sums[k]).all() for k in sums)
    for r in langid.identify(documents(texts), prototypes).collect():
        vector = brute_profile(texts[r.doc_id])
        if vector is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {k: vector @ v / np.linalg.norm(v) / np.linalg.norm(vector) for k, v in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r.score == pytest.approx(max(0.0, cosines[best]), abs=1e-9)
        # Two languages of the same text are a tie, which the first by code point wins.
        assert r.lang_pred == ("m" if best in "mn" else best)
    assert {r.lang_pred for r in langid.identify(documents(texts), {}).collect()} == {"und"}


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prototypes = langid.language_prototypes(langid.trained_on(docs))
    found = langid.identify(docs, prototypes).withColumn("held", langid.held_out()).collect()
    held = [r for r in found if r.held and r.lang is not None and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held) > 100
    assert all(0 <= r.score <= 1 for r in found)
    again = langid.language_prototypes(langid.trained_on(docs.repartition(7)))
    assert all((again[k] == prototypes[k]).all() for k in prototypes)


def test_language_id_of_odd_texts(documents):
    docs = documents([None, "", "12 .,-", "the the of", "le la les", "the"], langs=[None, "en", "en", "en", "fr", None])
    prototypes = langid.language_prototypes(docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, prototypes).collect()}
    assert [found[k] for k in range(3)] == [("und", 0.0)] * 3
    assert [found[k][0] for k in (3, 4, 5)] == ["en", "fr", "en"]
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.language_prototypes(docs.limit(0)) == {}


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: 3 * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        more = {s for s in free if target[s] > 3 * sizes[s]}
        if not more:
            return target
        capped |= more


def test_mixing(documents):
    draw = random.Random(2)
    sources = [draw.choice(["b", "a", "é", "Z", None]) for _ in range(400)] + ["tiny", "none", "none"]
    texts = [prose(k, draw.randint(1, 60)) for k in range(400)] + ["one two", "", None]
    docs = documents([*texts, texts[5]], [*range(len(texts)), 5], [*sources, sources[5]])
    rows = mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        assert r.mix_size == len((r.text or "").split())
        sizes[r.source] += r.mix_size
    target, taken = brute_targets(dict(sizes)), Counter()
    for r in rows:
        assert r.mix_source_size == sizes[r.source] and abs(r.mix_target - target[r.source]) < 1e-6
        assert 0 <= r.mix_copies <= 3
        taken[r.source] += r.mix_copies * r.mix_size
    assert all(abs(taken[s] - target[s]) <= max(4, 0.01 * target[s]) for s in sizes if s != "tiny")
    again = {(r.doc_id, r.text): r.mix_copies for r in mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.text): r.mix_copies for r in rows}
    assert repeat_rows(mix(docs)).count() == sum(r.mix_copies for r in rows)
    assert mix(docs.limit(0)).count() == 0


def test_mixing_favours(documents):
    texts = [prose(k, 10) for k in range(600)]
    docs = documents(texts, sources=["a"] * 300 + ["b"] * 300).withColumn("likes", F.when(F.col("doc_id") % 2 == 0, 20.0).otherwise(1.0))
    copies = {r.doc_id: r.mix_copies for r in mix(docs, favour=F.col("likes")).collect()}
    assert sum(copies[k] for k in range(0, 300, 2)) > 1.5 * sum(copies[k] for k in range(1, 300, 2))
