"""Token ids as Simple-8b blocks in files, and back.

``write_token_blocks`` deals the documents out by ranges of doc_id, encodes each range in its own task and
writes one Parquet row per block; Spark's writer makes the files reappear whole if a task is lost, on any
store. ``read_token_blocks`` decodes them. A block ends with a document, after BLOCK_IDS ids or more. Its first
``n_unnamed`` documents have a null doc_id, written as 0.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayspark.llm import simple8b
from assayspark.llm.common import join_small, small_batches, take_worker

BLOCK_IDS = 1 << 16
#: Words whose ids a worker remembers, about 60 bytes each; when full it starts anew. Results don't depend on it.
MEMORY = 1_200_000
#: Unknown words encoded in one call.
TOGETHER = 256
#: Documents split into words at a time within a task; the arrays of their words take some 20 times the text.
DOCS_AT_ONCE = 512
WORD_END = "</w>"
#: Two keys give the two halves of a word's hash.
HASH_KEYS = ("token words one.", "token words two.")
#: A Latin letter that no normalisation takes apart, then a run of marks up to the end of a word. The tokenizer cuts between letters and
#: marks. An apostrophe begins contractions, and "<", ">" and "|" stand in special tokens; words with these stay whole.
SENTENCE_END = r"([A-Za-zÀ-ÖØ-öø-įı-ɏ])([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]+)(\s|$)"
BLOCK_SCHEMA = (
    "shard int, block int, first long, n_ids long, n_unnamed long, doc_ids array<long>, doc_lens array<long>, "
    "payload binary"
)
BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("n_unnamed", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())), ("payload", pa.binary()),
])
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
_workers: dict[str, WordCoder] = {}


class WordStore:
    """Ids of many words in a few arrays: a word is told by 128 bits of hash, its ids are a stretch of one array."""

    def __init__(self) -> None:
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def __len__(self) -> int:
        return len(self.starts)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each word, -1 if it is not there, and the two halves of its hash."""
        key, check = (pd.util.hash_array(words, hash_key=k, categorize=False) for k in HASH_KEYS)
        if not len(self.keys):
            return np.full(len(words), -1), key, check
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (self.checks[at] == check)
        return np.where(known, self.places[at], -1), key, check

    def add(self, key: np.ndarray, check: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        """Places of new words with these ids."""
        places = np.arange(len(found)) + len(self)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, *found])
        order = np.argsort(key, kind="stable")
        at = np.searchsorted(self.keys, key[order])
        self.keys = np.insert(self.keys, at, key[order])
        self.checks = np.insert(self.checks, at, check[order])
        self.places = np.insert(self.places, at, places[order])
        return places


class WordCoder:
    """Ids of texts as little-endian unsigned 32-bit integers, word by word.

    White space is dropped by this tokenizer and none of its pieces reaches across, so the ids of a
    text are those of its words in a row. Words are cut at ASCII white space only; any other
    white space stays inside a word and is left to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.store = WordStore()

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word: words of letters many as one text, told apart by their last pieces, the others one by one."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = [k for k, w in enumerate(words) if w.isalpha()]
        groups = [plain[at:at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([" ".join([words[k] for k in g]) for g in groups], add_special_tokens=False)
        for group, coded in zip(groups, joined, strict=True):
            found = np.array(coded.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(group) and stops[-1] == len(found):
                for k, a, b in zip(group, [0, *stops[:-1].tolist()], stops.tolist(), strict=True):
                    out[k] = found[a:b]
        rest = [k for k, own in enumerate(out) if own is None]
        alone = self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)
        for k, coded in zip(rest, alone, strict=True):
            out[k] = np.array(coded.ids, dtype="<u4")
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text.

        Every different word is looked up once. Marks behind a Latin letter at the end of a word are a word of
        their own, and ASCII words without "<", which special tokens begin with, are put in lower case, as the tokenizer does both.
        """
        apart = pc.replace_substring_regex(texts, SENTENCE_END, r"\1 \2\3")
        split = pc.ascii_split_whitespace(apart.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        written = coded.dictionary
        folds = pc.and_(pc.string_is_ascii(written), pc.invert(pc.match_substring(written, "<")))
        folded = pc.if_else(folds, pc.ascii_lower(written), written).dictionary_encode()
        words = folded.dictionary.to_numpy(zero_copy_only=False)
        place, key, check = self.store.find(words)
        missing = np.flatnonzero(place < 0)
        if len(missing) and len(self.store) + len(missing) > MEMORY:
            self.store, missing = WordStore(), np.arange(len(words))
        if len(missing):
            place[missing] = self.store.add(key[missing], check[missing], self._encode(words[missing].tolist()))
        sizes, starts = self.store.sizes[place], self.store.starts[place]
        at = folded.indices.to_numpy()[coded.indices.to_numpy()]
        lens = sizes[at]
        before = np.r_[0, np.cumsum(lens)]
        found = self.store.flat[np.repeat(starts[at] - before[:-1], lens) + np.arange(before[-1])]
        ends = np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]
        return found, np.diff(before[ends])


def coder(path: str) -> WordCoder:
    """One per worker process and file."""
    if path not in _workers:
        _workers[path] = WordCoder(path)
    return _workers[path]


def write_token_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Write the ids of all documents, in ascending order of doc_id, to ``path``.

    A null or empty text has the end id alone. A null doc_id comes first. Rows with the same doc_id
    stand next to each other, ordered by a hash of the text. No rows give files without blocks.
    Other columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"),
    )
    order = [F.desc("unnamed"), F.asc("doc_id"), F.asc("tie")]
    parts = _parts(docs.sparkSession)
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = dealt.withColumn("shard", F.spark_partition_id()).mapInArrow(_writer(tokenizer, end_id), BLOCK_SCHEMA)
    with small_batches(docs.sparkSession):
        blocks.write.mode("overwrite").parquet(path)


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _writer(tokenizer: str, end_id: int):
    end = np.array([end_id], dtype="<u4")

    def block(shard: int, number: int, first: int, unnamed: int, ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate([part for text in texts for part in (text, end)])
        columns = [[shard], [number], [first], [len(values)], [unnamed], [ids], [[len(t) + 1 for t in texts]],
                   [simple8b.encode(values)]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, BLOCK_ARROW, strict=True)], schema=BLOCK_ARROW
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker(__name__, _workers.clear)
        own = coder(tokenizer)
        shard, number, first, held, unnamed, ids, texts = 0, 0, 0, 0, 0, [], []
        for batch in batches:
            if not len(batch):
                continue
            shard = batch["shard"][0].as_py()
            for at in range(0, len(batch), DOCS_AT_ONCE):
                several = batch.slice(at, DOCS_AT_ONCE)
                found, lens = own.ids(several["text"])
                parts = np.split(found, np.cumsum(lens)[:-1])
                for doc_id, nameless, text in zip(
                    several["doc_id"].to_pylist(), several["unnamed"].to_pylist(), parts, strict=True
                ):
                    ids.append(doc_id)
                    texts.append(text)
                    unnamed += nameless
                    held += len(text) + 1
                    if held >= BLOCK_IDS:
                        yield block(shard, number, first, unnamed, ids, texts)
                        number, first, held, unnamed, ids, texts = number + 1, first + held, 0, 0, [], []
        if ids:
            yield block(shard, number, first, unnamed, ids, texts)

    return write


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of ids before each, in the order of the files' documents."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written file.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select(
        "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset")
    )
    placed = join_small(blocks, shards, ["shard"], "inner", 16)
    return placed.withColumn("start", F.col("offset") + F.col("first")).drop("offset")


def document_digests(blocks: DataFrame) -> DataFrame:
    """Decode blocks: doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers."""
    return blocks.select("start", "n_unnamed", "doc_ids", "doc_lens", "payload").mapInPandas(_digest, DOC_SCHEMA)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, unnamed, ids, lens, payload in batch.itertuples(index=False):
            values = simple8b.decode(bytes(payload)).astype("<u4")
            lens = np.asarray(lens, dtype=np.int64)
            ends = np.cumsum(lens)
            sums = [zlib.crc32(values[e - n:e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
            named = pd.array(np.asarray(ids, dtype=np.int64), dtype="Int64")
            named[:unnamed] = pd.NA
            yield pd.DataFrame({
                "doc_id": named, "start": int(start) + ends - lens, "n_tokens": lens,
                "ids_crc32": sums,
            })
