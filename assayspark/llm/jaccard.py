"""N-gram Jaccard join: exact links between documents whose shingle sets are similar.

Index. The hash order of the shingles is cut into blocks by position, as many that two similar sets must
agree on a whole block: with t the least similarity, similar sets of which the smaller has s shingles
differ in at most s(1-t)/t. The index has one list per block content, so a probe skips every block that isn't equal.
A set is in the lists of its fullest blocks only, one more of them than can differ.
Shingles of many documents are left out of the blocks where enough others remain; a set for which they don't remain gets
blocks of all its shingles as well, and, if those are still too few, its empty blocks. So no link is lost.

A short list gives its pairs, of which those go that sketches prove dissimilar. Long lists are not counted out in pairs.

Answers. Pairs and long lists that share a set form a candidate group. Inside it every set's overlaps with the others are derived
from those of the set before it by the shingles in which the two differ, where these are fewer than its
own; of each shingle's list, which is ordered by set size, only the positions of possible sizes are read. The sets follow each other
by size, and sets of one size by their smallest shingle hashes, as those of similar sets mostly agree. Groups beyond a number of
shingles are cut into bands of sizes and these into portions; portions of a band meet each other and those of the next band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayspark.llm.common import components, cut_lineage, join_small, take_worker
from assayspark.llm.groups import linked_lowest
from assayspark.llm.shingles import mix, shingle_sets, sliced_sets
from assayspark.operators.scale import release

#: Share of the documents, over all and within a batch, from which a shingle counts as one of many documents. It
#: steers the work, not the result; at most (shingles per document) / FREQUENT shingles can pass it.
FREQUENT = 0.0005
FREQUENT_IN_BATCH = 0.001
#: Sets of a list whose pairs are looked at one by one; a longer list makes one candidate group of its sets.
SHORT_LIST = 16
#: Shingles in one portion of a candidate group.
PORTION = 200_000


def _levels(percent: int) -> np.ndarray:
    """Largest set size of each level."""
    return 1 << np.arange(41, dtype=np.int64)


def _most_apart(size: int, percent: int) -> int:
    """Most shingles by which a set of this size and a similar one that is not smaller can differ."""
    return size * (100 - percent) // percent


def _blocks_of(level_size: int, percent: int) -> int:
    most = _most_apart(level_size, percent)
    return most + 1 if most == 0 else most + most // 8 + 2


def _block_keys(own: np.ndarray, rare: np.ndarray, percent: int, levels: np.ndarray) -> np.ndarray:
    """Keys of the lists that a set is in.

    Two similar sets meet at the level of the smaller one, where each has at most ``need - 1`` blocks that the other has not. So of its
    blocks in one order, which depends on their contents alone, the first ``need`` suffice: the first common one is among them. Blocks
    of many shingles come first, as they are equal by chance least often.
    """
    n = len(own)
    smallest = -(-n * percent // 100)
    scrambled, weights = mix(own, 7), mix(own, 8)
    keys = []
    for level in range(int(np.searchsorted(levels, smallest)), int(np.searchsorted(levels, n)) + 1):
        blocks = _blocks_of(int(levels[level]), percent)
        need = _most_apart(min(n, int(levels[level])), percent) + 1
        place = ((scrambled >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)

        def contents(chosen: np.ndarray, kind: int, place=place, blocks=blocks, level=level, need=need) -> tuple[int, np.ndarray]:
            counts = np.bincount(place[chosen], minlength=blocks)
            sums = np.zeros(blocks, dtype=np.uint64)
            np.add.at(sums, place[chosen], weights[chosen])
            used = np.flatnonzero(counts)
            named = np.arange(blocks, dtype=np.uint64) + np.uint64((level * 4 + kind) << 44)
            found = mix(sums[used] + mix(named[used]))
            keys.append(found[np.lexsort((found, -counts[used]))[:need]] if len(used) > need else found)
            return len(used), named[counts == 0]

        if contents(rare, 0)[0] < need:
            used, empty = contents(np.ones(n, dtype=bool), 1)
            if used < need:
                keys.append(mix(mix(empty[:need - used] + np.uint64(1 << 44))))
    return np.concatenate(keys).view(np.int64)


def _identity(own: np.ndarray) -> tuple[int, int]:
    return int(mix(own, 1).sum(dtype=np.uint64).view(np.int64)), int(mix(own, 2).sum(dtype=np.uint64).view(np.int64))


def _describe(size: int):
    """Per document its set's size and identity (``kind`` 0); per batch the frequent shingles (``kind`` 1)."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        take_worker(__name__)
        for batch in batches:
            held, first = [], 0
            for sets in sliced_sets(batch["text"].tolist(), size):
                ids = [_identity(s) for s in sets]
                yield pd.DataFrame({
                    "kind": 0, "doc_id": batch["doc_id"].iloc[first:first + len(sets)].to_numpy(), "n": [len(s) for s in sets],
                    "k1": np.array([i for i, _ in ids], dtype=np.int64), "k2": np.array([i for _, i in ids], dtype=np.int64),
                    "sketch": [_sketch(s) for s in sets],
                })
                first += len(sets)
                held.append(np.concatenate(sets))
            flat = np.concatenate([*held, np.zeros(0, np.uint64)])
            held.clear()
            flat.sort()
            edges = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]])) if len(flat) else np.zeros(1, np.int64)
            found, counts = flat[edges[:-1]], np.diff(edges)
            often = counts >= max(3, FREQUENT_IN_BATCH * len(batch))
            yield pd.DataFrame({
                "kind": 1, "doc_id": pd.array([pd.NA] * int(often.sum()), dtype="Int64"), "n": counts[often],
                "k1": found[often].view(np.int64), "k2": np.int64(0), "sketch": b"",
            })

    return describe


def _index(size: int, percent: int, frequent: np.ndarray):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        take_worker(__name__)
        levels = _levels(percent)
        for batch in batches:
            for sets in sliced_sets(batch["text"].tolist(), size):
                keys, owners = [], []
                for own in sets:
                    if len(own):
                        at = np.searchsorted(frequent, own)
                        at[at == len(frequent)] = 0
                        rare = frequent[at] != own if len(frequent) else np.ones(len(own), dtype=bool)
                        found = _block_keys(own, rare, percent, levels)
                        keys.append(found)
                        owners.append(np.full(len(found), _identity(own)[0], dtype=np.int64))
                if keys:
                    yield pd.DataFrame({"key": np.concatenate(keys), "owner": np.concatenate(owners)})

    return index


PAIR, CHAIN, END = range(3)


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of (key, owner): what each list says about its sets.

    A list of at most SHORT_LIST sets gives all its PAIRs, a longer one a CHAIN from set to set, which joins them in one candidate
    group without counting pairs. A list that may go on in another partition is a chain, with its key and one set as END.
    """
    held: tuple[np.ndarray, np.ndarray] | None = None
    chained: set[int] = set()
    for batch in batches:
        if not len(batch):
            continue
        key, owner = batch["key"].to_numpy(), batch["owner"].to_numpy()
        if held is None:
            chained.add(int(key[0]))
            yield pd.DataFrame({"kind": END, "a": key[:1], "b": owner[:1]})
        else:
            key, owner = np.concatenate([held[0], key]), np.concatenate([held[1], owner])
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
        key, owner = key[fresh], owner[fresh]
        end = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])
        if len(key) - end > SHORT_LIST:
            # The list is known to be long: chain what is there, go on from its last set.
            chained.add(int(key[-1]))
            yield from _list_pairs(key, owner, chained)
            held = key[-1:], owner[-1:]
        else:
            yield from _list_pairs(key[:end], owner[:end], chained)
            held = key[end:], owner[end:]
    if held is not None:
        chained.add(int(held[0][-1]))
        yield from _list_pairs(*held, chained)
        yield pd.DataFrame({"kind": END, "a": held[0][-1:], "b": held[1][-1:]})


def _list_pairs(key: np.ndarray, owner: np.ndarray, chained: set[int]) -> Iterator[pd.DataFrame]:
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    starts, sizes = edges[:-1], np.diff(edges)
    long = (sizes > SHORT_LIST) | np.isin(key[starts], list(chained))
    for size in np.unique(sizes[~long & (sizes > 1)]):
        i, j = np.triu_indices(size, 1)
        own = starts[~long & (sizes == size)][:, None]
        pairs = np.unique(np.stack([owner[own + i].ravel(), owner[own + j].ravel()], axis=1), axis=0)
        yield pd.DataFrame({"kind": PAIR, "a": pairs[:, 0], "b": pairs[:, 1]})
    if (long & (sizes > 1)).any():
        linked = np.repeat(long, sizes)
        linked[starts] = False
        at = np.flatnonzero(linked)
        pairs = np.unique(np.stack([owner[at - 1], owner[at]], axis=1), axis=0)
        yield pd.DataFrame({"kind": CHAIN, "a": pairs[:, 0], "b": pairs[:, 1]})


def _sketch(own: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of a power of two of bins, about two bins a shingle."""
    bins = 1 << max(9, int(2 * len(own) - 1).bit_length())
    place = (mix(own, 9) % np.uint64(bins)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bins) & 1).astype(np.uint8)).tobytes()


def _may_link(percent: int):
    """Pairs that can be similar: each odd bin of two sketches takes a shingle in which the sets differ."""

    def may_link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            rows = batch[["n_a", "n_b", "sketch_a", "sketch_b"]].itertuples(index=False, name=None)
            for at, (n_a, n_b, one, two) in enumerate(rows):
                if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
                    continue
                one, two = np.frombuffer(one, dtype=np.uint64), np.frombuffer(two, dtype=np.uint64)
                while len(one) > len(two):
                    one = one[:len(one) // 2] ^ one[len(one) // 2:]
                while len(two) > len(one):
                    two = two[:len(two) // 2] ^ two[len(two) // 2:]
                odd = int(np.bitwise_count(one ^ two).sum())
                keep[at] = odd * (100 + percent) <= (100 - percent) * (n_a + n_b)
            yield batch.loc[keep, ["a", "b"]]

    return may_link


def _positions(entries: np.ndarray, tokens: np.ndarray, low: int, n: int) -> np.ndarray:
    """Positions of the tokens' lists from the first set not below ``low``; ``entries`` has token * n + set in order."""
    a, b = np.searchsorted(entries, tokens * n + low), np.searchsorted(entries, tokens * n + n)
    lengths = b - a
    return np.arange(lengths.sum()) + np.repeat(a - (np.cumsum(lengths) - lengths), lengths)


def overlaps_join(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the similar pairs: among all sets if their side is 2, across sides 0 and 1 otherwise."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    # Neighbours of one size share their smallest hashes if they are similar, so little is left to be derived.
    sketch = np.array([(s[0], s[min(1, len(s) - 1)]) for s in sets], dtype=np.int64)
    order = np.lexsort((sketch[:, 1], sketch[:, 0], sizes))
    n, sorted_sizes = len(sets), sizes[order]
    _, flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ends = np.cumsum(sorted_sizes)
    own = [np.sort(flat[e - s:e]) for s, e in zip(sorted_sizes.tolist(), ends.tolist(), strict=True)]
    owner = np.repeat(np.arange(n), sorted_sizes)
    entries = np.sort(flat * n + owner)
    holders = entries % n
    lowest = np.searchsorted(sorted_sizes, -(-sorted_sizes * percent // 100))

    def count(tokens: np.ndarray, low: int) -> np.ndarray:
        return np.bincount(holders[_positions(entries, tokens, low, n)] - low, minlength=n - low)

    left, right, before = [], [], None
    for place in range(n):
        low, tokens = int(lowest[place]), own[place]
        if before is not None:
            gained = np.setdiff1d(tokens, own[place - 1], assume_unique=True)
            lost = np.setdiff1d(own[place - 1], tokens, assume_unique=True)
        if before is not None and len(gained) + len(lost) < len(tokens):
            overlap = before[0][low - before[1]:] + count(gained, low) - count(lost, low)
        else:
            overlap = count(tokens, low)
        before = (overlap, low)
        earlier = overlap[:place - low]
        union = sorted_sizes[low:place] + sorted_sizes[place] - earlier
        near = np.flatnonzero(100 * earlier >= percent * union) + low
        left.append(near)
        right.append(np.full(len(near), place))
    none = np.zeros(0, dtype=np.int64)
    a, b = order[np.concatenate(left or [none])], order[np.concatenate(right or [none])]
    wanted = (side[a] == 2) | (side[a] != side[b])
    return a[wanted], b[wanted]


def _join(percent: int, size: int):
    def join(group: pd.DataFrame) -> pd.DataFrame:
        if group["side"].nunique() == 1 and group["side"].iloc[0] != 2:
            return pd.DataFrame({"node": [], "links": [], "lowest": []}).astype(np.int64)
        sets = list(shingle_sets(group["text"].tolist(), size))
        rows = zip(group["n"], group["k1"], group["k2"], sets, strict=True)
        # Rows of this doc_id with another text go. One that repeats its doc_id and text brings the set once more; its copies are counted.
        good = np.array([len(own) == n and _identity(own) == (k1, k2) for n, k1, k2, own in rows])
        found = np.flatnonzero(good)
        good[found[group["node"].iloc[found].duplicated().to_numpy()]] = False
        group = group[good].reset_index(drop=True)
        sets = [own.view(np.int64) for own, keep in zip(sets, good, strict=True) if keep]
        if len(sets) < 2:
            return pd.DataFrame({"node": [], "links": [], "lowest": []}).astype(np.int64)
        a, b = overlaps_join(sets, group["side"].to_numpy(), percent)
        nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        gained = np.bincount(a, copies[b], len(group)) + np.bincount(b, copies[a], len(group))
        met = np.flatnonzero(gained)
        lowest = linked_lowest(nodes, a, b)
        return pd.DataFrame({"node": nodes[met], "links": gained[met].astype(np.int64), "lowest": lowest[met]})

    return join


def meetings(drawn: Column) -> Column:
    """Array of (band, next, low, high, side): the meetings of a set whose portion of its band is ``drawn``.

    A row's band of sizes has ``own`` portions, the bands next to it ``down`` and ``up``. Portions of one band meet each other
    and those of the next band; sets farther apart are not similar.
    """

    def meet(band: Column, following: bool, low: Column, high: Column, side: Column) -> Column:
        return F.struct(
            band.cast("int").alias("band"), F.lit(following).alias("next"), low.cast("int").alias("low"),
            high.cast("int").alias("high"), side.cast("int").alias("side"),
        )

    def upto(n: str) -> Column:
        return F.filter(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1), lambda k: k < F.col(n))

    band = F.col("band")
    own = F.transform(upto("own"), lambda k: meet(
        band, False, F.least(k, drawn), F.greatest(k, drawn), F.when(k == drawn, 2).otherwise((k < drawn).cast("int"))
    ))
    up = F.transform(upto("up"), lambda k: meet(band, True, drawn, k, F.lit(0)))
    down = F.transform(upto("down"), lambda k: meet(band - 1, True, k, drawn, F.lit(1)))
    return F.concat(own, up, down)


def _banded(grouped: DataFrame, percent: int) -> DataFrame:
    """The rows (component, n, ...) of groups of several sets, with their band of sizes and the portions that it and its neighbours have.

    A band spans sizes that differ by ``percent``, so similar sets are in one band or in neighbouring ones. A group that fits one
    portion is one band.
    """
    sums = grouped.groupBy("component").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("sets"))
    wide = F.log(F.lit(100.0 / percent)) * (1 + 1e-9)
    several = grouped.join(sums.filter("sets > 1"), "component")
    placed = cut_lineage(several.withColumn(
        "band", F.when(F.col("tokens") <= PORTION, -1).otherwise(F.floor(F.log(F.col("n").cast("double")) / wide)).cast("int")
    ).drop("tokens", "sets"))
    bands = placed.groupBy("component", "band").agg(F.ceil(F.sum("n") / PORTION).cast("int").alias("own"))
    # A component has one row per band here.
    by_band = Window.partitionBy("component").orderBy("band")

    def beside(step: int) -> Column:
        there = F.lead("band", step).over(by_band) if step > 0 else F.lag("band", -step).over(by_band)
        own = F.lead("own", step).over(by_band) if step > 0 else F.lag("own", -step).over(by_band)
        return F.when(there == F.col("band") + step, own).otherwise(0)

    return placed.join(bands.withColumns({"up": beside(1), "down": beside(-1)}), ["component", "band"])


def jaccard_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, n_links, component_id.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of distinct ``size``-word
    shingles (see ``shingles``). n_shingles is the set's size, n_links the number of other documents linked directly,
    component_id the smallest doc_id reachable by links, the document's own included. A null or empty text, or one of
    white space, has size 0 and links with nothing. Documents with equal sets are one node of the join, with a number
    of copies. A row without a doc_id links with nothing and has a null component_id; rows that repeat a doc_id count
    as copies if their sets agree. Other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = cut_lineage(own.mapInPandas(_describe(size), "kind int, doc_id long, n long, k1 long, k2 long, sketch binary"))
    rows = described.filter("kind = 0").drop("kind", "sketch")
    linkable = rows.filter("n > 0 and doc_id is not null")
    classes = cut_lineage(linkable.groupBy("n", "k1", "k2").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")
    ))
    least = max(3.0, FREQUENT * linkable.count())
    often = described.filter("kind = 1").groupBy("k1").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    frequent = np.sort(np.array([r.k1 for r in often.select("k1").toLocalIterator()], dtype=np.int64).view(np.uint64))
    lists = own.filter("doc_id is not null").select("text").mapInPandas(
        _index(size, percent, frequent), "key long, owner long"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written first: dealing out by range reads its rows twice, once for a sample.
    index = cut_lineage(lists)
    dealt = index.repartitionByRange(parts, "key", "owner").sortWithinPartitions("key", "owner")
    met = cut_lineage(dealt.mapInPandas(_neighbours, "kind int, a long, b long"))
    release(index)
    ends = met.filter(f"kind = {END}")
    across = ends.join(ends.groupBy("a").agg(F.min("b").alias("first")), "a").select(F.col("first").alias("a"), "b")
    sketches = described.filter("kind = 0 and n > 0").groupBy("k1").agg(
        F.max(F.struct("n", "sketch")).alias("own")
    ).select("k1", "own.n", "own.sketch")
    sides = [sketches.withColumnsRenamed({"k1": c, "n": f"n_{c}", "sketch": f"sketch_{c}"}) for c in ("a", "b")]
    pairs = met.filter(f"kind = {PAIR}").select("a", "b").distinct().join(sides[0], "a").join(sides[1], "b")
    likely = cut_lineage(pairs.mapInPandas(_may_link(percent), "a long, b long"))
    chains = met.filter(f"kind = {CHAIN}").select("a", "b")
    candidates = components(likely.unionByName(chains).unionByName(across))
    grouped = classes.join(candidates.withColumnRenamed("node", "k1"), "k1")
    wanted = cut_lineage(_banded(grouped, percent))
    # Few texts are wanted, so the others are left where they are as long as the wanted ids can be broadcast.
    near = join_small(own, wanted.select(F.col("node").alias("doc_id")), ["doc_id"], "left_semi", 16)
    texts = near.join(wanted.withColumn("doc_id", F.col("node")), "doc_id")
    drawn = F.pmod(F.xxhash64("k2"), "own").cast("int")
    # Texts are sent, not their sets: they compress, hashes don't.
    portions = texts.withColumn("meet", F.explode(meetings(drawn))).select(
        "component", "meet.*", "node", "copies", "n", "k1", "k2", "text"
    )
    found = cut_lineage(portions.groupBy("component", "band", "next", "low", "high").applyInPandas(
        _join(percent, size), "node long, links long, lowest long"
    ))
    labels = components(found.filter("node != lowest"), "node", "lowest")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    summary = classes.join(counts, "node", "left").join(labels, "node", "left").select(
        "n", "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    back = rows.join(summary, ["n", "k1", "k2"], "left")
    named = F.col("doc_id").isNotNull()
    return back.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(named, F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
