"""Suffix-array dedup: the bytes of windows that a document with a smaller doc_id has too.

1. Every document gives its anchors (see ``anchors``), each with a hash of all bytes its windows cover. Ordered by anchor
   and cover, a row whose cover also stands in a smaller document is removed whole. This settles the inside of long repeats.
   Covers are told apart by all 64 bits of their hash; their bytes are not compared.
2. What is left are covers that share an anchor but differ: the edges of repeats. Their bytes are brought together by
   anchor in bounded blocks; each block gets a suffix array by Lyndon grouping, in which equal windows are neighbours.
3. An anchor with more covers than a block holds is cut; the windows of its blocks are matched by their hashes, with a
   minimum per window that Spark combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.anchors import JOINED, LENGTH, joined_anchors, text_anchors, window_hashes
from assayspark.llm.common import cut_lineage
from assayspark.llm.lyndon import suffix_array

#: Covers in one suffix array.
BLOCK = 512
#: Covers cut out before a task hands them on.
PIECES = 1 << 14
#: Rows gathered before a task hands them on, and most rows of one anchor looked at together.
ROWS = 1 << 18
#: Rows of covers that a task settles at once; it gets fewer at a time.
GATHERED = 1 << 15


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for docs, texts in _few_bytes(batch):
            if len(texts) > 1:
                text, anchor, cover, first, shape = joined_anchors(texts)
                found = [(anchor, cover, docs[text], first * 4096 + shape)]
            else:
                parts = text_anchors(np.frombuffer(texts[0], dtype=np.uint8))
                found = [(a, c, np.full(len(first), docs[0]), first * 4096 + shape) for a, c, first, shape in parts]
            held += found
            size += sum(len(f[0]) for f in found)
            if size >= ROWS:
                yield _anchor_rows(held)
                held, size = [], 0
    if held:
        yield _anchor_rows(held)


def _few_bytes(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Neighbouring rows whose texts have JOINED bytes together, or single ones."""
    docs, texts = batch["doc"].to_numpy(), batch["text"].tolist()
    ends = np.cumsum([len(t) for t in texts])
    at = 0
    while at < len(texts):
        before = ends[at] - len(texts[at])
        after = max(at + 1, int(np.searchsorted(ends, before + JOINED, side="right")))
        yield docs[at:after], texts[at:after]
        at = after


def _anchor_rows(held: list[tuple]) -> pd.DataFrame:
    anchor, cover, doc, place = (np.concatenate(c) for c in zip(*held, strict=True))
    return pd.DataFrame({"anchor": anchor.view(np.int64), "cover": cover.view(np.int64), "doc": doc, "place": place})


COVERED, OPEN, FIRST_RUN, EDGE = range(4)
SETTLED = "kind int, anchor long, cover long, doc long, place long"


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of (anchor, cover, doc, place).

    COVERED: the cover stands in a smaller document. OPEN: it doesn't, but the anchor has other covers and documents. An
    anchor that may go on elsewhere, at either end of a partition or after ROWS rows, counts as having others. The rows of
    a partition's first cover that it can't settle are FIRST_RUN, and EDGE rows name the smallest document of its first and
    last cover.
    """
    state: dict = {"forced": set(), "run": None, "first": None}
    held: list[np.ndarray] | None = None
    for new in _gathered(batches):
        if held is None:
            state["first"] = (new[0][0], new[1][0])
            state["forced"].add(new[0][0])
            yield _settled(EDGE, *(c[:1] for c in new))
        else:
            new = [np.concatenate(c) for c in zip(held, new, strict=True)]
        end = int(np.flatnonzero(np.concatenate([[True], new[0][1:] != new[0][:-1]]))[-1])
        if len(new[0]) - end > ROWS:
            state["forced"].add(new[0][-1])
            end = len(new[0])
        yield from _settle_part([c[:end] for c in new], state)
        held = [c[end:] for c in new]
    if held is not None:
        if len(held[0]):
            state["forced"].add(held[0][0])
            yield from _settle_part(held, state)
        yield _settled(EDGE, *(np.array([x]) for x in (*state["run"], 0)))


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
    """The columns of several batches, GATHERED rows or more but for the last."""
    parts: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        if len(batch):
            parts.append([batch[c].to_numpy() for c in ("anchor", "cover", "doc", "place")])
            size += len(batch)
        if size >= GATHERED:
            yield [np.concatenate(c) for c in zip(*parts, strict=True)]
            parts, size = [], 0
    if parts:
        yield [np.concatenate(c) for c in zip(*parts, strict=True)]


def _settle_part(rows: list[np.ndarray], state: dict) -> Iterator[pd.DataFrame]:
    anchor, cover, doc, place = rows
    if not len(doc):
        return
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new_run = new_anchor | np.concatenate([[True], cover[1:] != cover[:-1]])
    leaders = doc[new_run]
    if state["run"] is not None and state["run"][:2] == (anchor[0], cover[0]):
        leaders[0] = state["run"][2]
    leader = leaders[np.cumsum(new_run) - 1]
    covered = doc > leader
    # Their place is all that is asked of them later; zeros take no room.
    yield _settled(COVERED, 0, 0, doc[covered], place[covered])
    in_first = (anchor == state["first"][0]) & (cover == state["first"][1]) & ~covered
    yield _settled(FIRST_RUN, *(c[in_first] for c in rows))
    group, starts = np.cumsum(new_anchor) - 1, np.flatnonzero(new_anchor)
    several = (np.bincount(group, new_run) >= 2) & (
        np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
    )
    shown = (several | np.isin(anchor[starts], list(state["forced"])))[group] & ~covered & ~in_first
    yield _settled(OPEN, *(c[shown] for c in rows))
    state["run"] = (anchor[-1], cover[-1], leader[-1])
    state["forced"] &= {state["first"][0], anchor[-1]}


def _settled(kind: int, anchor, cover, doc, place) -> pd.DataFrame:
    return pd.DataFrame({"kind": kind, "anchor": anchor, "cover": cover, "doc": doc, "place": place})


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut the covers of each document's open anchors out of its bytes, PIECES of them at a time."""
    out: list[tuple] = []
    for batch in batches:
        for doc, text, anchors, places in batch.itertuples(index=False):
            for anchor, place in zip(anchors.tolist(), places.tolist(), strict=True):
                start = place >> 12
                piece = text[start:start + (place & 63) + LENGTH]
                if len(piece) >= LENGTH:
                    out.append((anchor, doc, start, piece))
            if len(out) >= PIECES:
                yield pd.DataFrame(out, columns=["anchor", "doc", "start", "piece"])
                out = []
    if out:
        yield pd.DataFrame(out, columns=["anchor", "doc", "start", "piece"])


SPAN, WINDOW = range(2)
FOUND = "kind int, doc long, start long, stop long, key long, check long"


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Covers in order of anchor: removed stretches (SPAN), and the other windows of anchors that were cut (WINDOW)."""
    block: list[tuple] = []
    cut: set[int] = set()
    for rows, parted in _by_anchor(batches):
        block += rows
        if parted:
            cut.add(rows[0][0])
        if len(block) >= BLOCK:
            yield _block(block, cut)
            block, cut = [], set()
    if block:
        yield _block(block, cut)


def _by_anchor(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[tuple], bool]]:
    """The rows of one anchor, BLOCK at most, and whether the anchor may have others: those first and last here, and large ones."""
    rows: list[tuple] = []
    parted = True
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            if rows and row[0] != rows[0][0]:
                yield rows, parted
                rows, parted = [], False
            elif len(rows) >= BLOCK:
                yield rows, True
                rows, parted = [], True
            rows.append(row)
    if rows:
        yield rows, True


def _block(rows: list[tuple], cut: set[int]) -> pd.DataFrame:
    """Equal windows of the block's covers, from the suffix array of those stretches that share window hashes."""
    pieces = [r[3] for r in rows]
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    joined = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    row_of = np.repeat(np.arange(len(rows)), sizes)
    starts = np.flatnonzero(np.arange(len(joined)) + LENGTH <= ends[row_of])
    keys = window_hashes(joined, 5)[starts]
    docs = np.array([r[1] for r in rows], dtype=np.int64)
    owner = row_of[starts]
    gone = np.zeros(len(joined), dtype=bool)
    order = np.argsort(keys, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    own = docs[owner[order]]
    shared = np.minimum.reduceat(own, edge) < np.maximum.reduceat(own, edge)
    hits = np.repeat(shared, np.diff(np.append(edge, len(order))))
    at = np.sort(order[hits])
    chosen, first = np.unique(owner[at], return_index=True)
    if len(chosen):
        # Of each such cover the bytes from its first to its last shared window.
        low = starts[at[first]]
        high = starts[at[np.append(first[1:], len(at)) - 1]] + LENGTH
        text = joined.tobytes()
        piece, offset = _equal_windows([text[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)], docs[chosen])
        gone[low[piece] + offset] = True
    return _found_rows(rows, ends - sizes, row_of, starts, gone, keys, joined, cut)


def _equal_windows(pieces: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the windows that a piece of a smaller document has too."""
    text = b"".join(pieces)
    sizes = [len(p) for p in pieces]
    piece_of = np.repeat(np.arange(len(pieces)), sizes)
    first = np.cumsum(sizes) - sizes
    offset = np.arange(len(text)) - first[piece_of]
    whole = offset + LENGTH <= np.array(sizes)[piece_of]
    order = np.array(suffix_array(text))
    order = order[whole[order]]
    windows = [text[p:p + LENGTH] for p in order.tolist()]
    new = np.array([True] + [a != b for a, b in zip(windows, windows[1:], strict=False)])
    own = docs[piece_of[order]]
    least = np.minimum.reduceat(own, np.flatnonzero(new))[np.cumsum(new) - 1]
    gone = order[own > least]
    return piece_of[gone], offset[gone]


def _found_rows(rows, first, row_of, starts, gone, keys, joined, cut) -> pd.DataFrame:
    at = np.array([r[2] for r in rows], dtype=np.int64)
    docs = np.array([r[1] for r in rows], dtype=np.int64)
    lost = np.flatnonzero(gone)
    owner = row_of[lost]
    spans = pd.DataFrame({
        "kind": SPAN, "doc": docs[owner], "start": at[owner] + lost - first[owner], "stop": 0, "key": 0, "check": 0,
    })
    spans = _merged(spans)
    if not cut:
        return spans
    parted = np.array([r[0] in cut for r in rows])
    left = starts[parted[row_of[starts]] & ~gone[starts]]
    owner = row_of[left]
    place = np.searchsorted(starts, left)
    begin = at[owner] + left - first[owner]
    windows = pd.DataFrame({
        "kind": WINDOW, "doc": docs[owner], "start": begin, "stop": begin + LENGTH,
        "key": keys[place].view(np.int64), "check": window_hashes(joined, 6)[left].view(np.int64),
    })
    return pd.concat([spans, windows], ignore_index=True)


def _merged(spans: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring windows as one stretch."""
    spans = spans.drop_duplicates(["doc", "start"]).sort_values(["doc", "start"], ignore_index=True)
    doc, start = spans["doc"].to_numpy(), spans["start"].to_numpy()
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])[:len(doc)]
    last = np.concatenate([fresh[1:], [True]])[:len(doc)]
    out = spans[fresh].copy()
    out["stop"] = start[last] + LENGTH
    return out


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """(doc_id, starts, stops): byte stretches of each text to remove, which may overlap and come in no order.

    ``docs`` has doc_id and text. A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller
    doc_id; strings are judged on the input. Texts shorter than LENGTH bytes, null or empty have none. A row without
    a doc_id neither removes nor is removed; rows that repeat a doc_id don't remove each other.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").cast("binary").alias("text")
    )
    rows = texts.mapInPandas(_anchors, "anchor long, cover long, doc long, place long")
    order = ["anchor", "cover", "doc", "place"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    settled = cut_lineage(dealt.mapInPandas(_settle, SETTLED))
    edge = settled.filter(f"kind = {EDGE}").groupBy("anchor", "cover").agg(F.min("doc").alias("leader"))
    first = settled.filter(f"kind = {FIRST_RUN}").join(edge, ["anchor", "cover"])
    columns = ["anchor", "doc", "place"]
    whole = settled.filter(f"kind = {COVERED}").select("doc", "place").unionByName(
        first.filter("doc > leader").select("doc", "place")
    )
    opened = settled.filter(f"kind = {OPEN}").select(*columns).unionByName(
        first.filter("doc <= leader").select(*columns)
    )
    listed = opened.groupBy("doc").agg(F.collect_set(F.struct("anchor", "place")).alias("open"))
    with_text = texts.join(listed, "doc").select("doc", "text", "open.anchor", "open.place")
    pieces = cut_lineage(with_text.mapInPandas(_contexts, "anchor long, doc long, start long, piece binary"))
    met = pieces.repartitionByRange(parts, "anchor", "piece").sortWithinPartitions("anchor", "piece")
    found = cut_lineage(met.mapInPandas(_edges, FOUND))
    windows = found.filter(f"kind = {WINDOW}")
    least = windows.groupBy("key", "check").agg(F.min("doc").alias("least"))
    across = windows.join(least, ["key", "check"]).filter("doc > least")
    start = F.shiftright("place", 12)
    stretches = whole.select(
        "doc", start.alias("start"), (start + F.col("place").bitwiseAND(63) + LENGTH).alias("stop")
    ).unionByName(found.filter(f"kind = {SPAN}").select("doc", "start", "stop")).unionByName(
        across.select("doc", "start", "stop")
    )
    lists = stretches.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    return lists.select(F.col("doc").alias("doc_id"), F.col("gone.start").alias("starts"),
                        F.col("gone.stop").alias("stops"))


def _strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, text, starts, stops in batch.itertuples(index=False):
            spans = 0
            kept = text
            if starts is not None and len(starts):
                edges = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(edges, np.minimum(starts, len(text)), 1)
                np.add.at(edges, np.minimum(stops, len(text)), -1)
                gone = np.cumsum(edges[:-1]) > 0
                spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            out.append((doc, len(text), len(text) - len(kept), spans, kept))
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def strip_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the bytes ``kept``.

    See ``repeated_stretches``; a null text counts as empty. Kept bytes need not be valid UTF-8, as a
    stretch may end inside a character. Other columns are not read.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    joined = texts.join(cut_lineage(repeated_stretches(docs)), "doc_id", "left")
    return joined.select("doc_id", "text", "starts", "stops").mapInPandas(
        _strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
