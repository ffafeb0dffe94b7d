"""Benchmark decontamination by templates.

A word, without punctuation at either end, becomes a placeholder if it begins with a digit (a number), is a unit of measure,
or begins with a capital (a name). Windows of template words, and of words in lower case, are hash-joined with those of
the benchmark. A window of placeholders alone counts for nothing, as it fits any list of names, but its words still are
compared: a window whose words equal the item's but for case counts as it is. Windows with exchanged words count in runs, which
end at windows without: in a run equal slots of the item must be filled alike in the document and different ones
differently. Numbers, names and units may thus have been exchanged, but not at random. A document holds an item if
enough of the item's windows count, or if it has EXCERPT words of the item in a row. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import BLANKS, computed, cut_lineage, join_small

WINDOW = 5
PERCENT = 80
#: Words of an item in a row that are enough, whatever its length.
EXCERPT = 30
PUNCTUATION = ".,;:!?\"'()[]{}<>*_`~|/\\«»„“”‚‘’…–—¿¡-+$€£%"
# Units of measure that are no ordinary words.
UNITS = """mm cm km inch inches ft feet yd yards mi miles mg kg oz lb lbs pounds ml cl litre litres liter liters gal gallons
    sec seconds minutes hr hrs hour hours day days week weeks month months year years mph kmh hz khz mhz ghz kw mw kj kcal
    kb mb gb tb usd eur gbp dollar dollars cent cents euro euros percent degrees""".split()
#: What a placeholder's hash is; a literal word's hash is odd, so AND and OR of a window's hashes tell what it holds.
NUMBER, UNIT, NAME = 2, 4, 6


def bare_words(text: Column) -> Column:
    """Words without punctuation at either end; words of punctuation alone are left out."""
    found = F.transform(F.split(text, BLANKS), lambda w: F.btrim(w, F.lit(PUNCTUATION)))
    return F.coalesce(F.filter(found, lambda w: w != ""), F.array().cast("array<string>"))


def word_hashes(words: Column) -> Column:
    """(low, one) of each bare word: the hash of the word in lower case, and that of its place in the template."""

    def hashes(word: Column) -> Column:
        folded = F.lower(word)
        low = F.xxhash64(folded).bitwiseOR(F.lit(1))
        first = F.substring(word, 1, 1)
        kind = F.when((first >= "0") & (first <= "9"), NUMBER).when(folded.isin(*UNITS), UNIT).when(
            first != F.lower(first), NAME
        )
        return F.struct(low.alias("low"), F.coalesce(kind.cast("bigint"), low).alias("one"))

    return F.transform(words, hashes)


def template_windows(rows: DataFrame, key: str, window: int = WINDOW) -> DataFrame:
    """(key, place, hash) of every window of ``text``: by its words in lower case, and by its template if that has both a
    placeholder and a literal word. A template of placeholders alone fits any list of names or numbers and gives no hash.

    Fewer words than ``window`` make one window, none makes none.
    """
    hashed = computed(rows.select(key, "text"), "own", word_hashes(bare_words(F.col("text")))).select(
        key, F.col("own.low").alias("low"), F.col("own.one").alias("one"), F.size("own").alias("n")
    ).filter("n > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))

    def own(at: Column) -> Column:
        low = [F.get("low", at + k) for k in range(window)]
        one = [F.get("one", at + k) for k in range(window)]
        every, some = F.coalesce(one[0], F.lit(1)), F.coalesce(one[0], F.lit(0))
        for value in one[1:]:
            every = every.bitwiseAND(F.coalesce(value, F.lit(1)))
            some = some.bitwiseOR(F.coalesce(value, F.lit(0)))
        mixed = (every.bitwiseAND(F.lit(1)) == 0) & (some.bitwiseAND(F.lit(1)) == 1)
        by_words, by_template = F.xxhash64(*low), F.xxhash64(*one, F.lit(1))
        return F.when(mixed, F.array(by_words, by_template)).otherwise(F.array(by_words))

    placed = hashed.select(key, F.posexplode(F.transform(starts, own)).alias("place", "own"))
    return placed.select(key, "place", F.explode("own").alias("hash"))


def telling_places(words: Column, window: int = WINDOW) -> Column:
    """Places of the windows with a literal word, or of all windows if there is none: those that can count."""
    literal = F.transform(word_hashes(words), lambda h: h.one.bitwiseAND(F.lit(1)) == 1)
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - window, F.lit(0)))
    some = F.filter(every, lambda at: F.exists(F.slice(literal, at + 1, window), lambda x: x))
    return F.when(F.size(some) > 0, some).otherwise(every)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The items with their words and the places that can count, and their windows; both written tables."""
    items = cut_lineage(benchmark.filter(F.col("text").isNotNull()).select(
        F.xxhash64("item_id", "text").alias("item"), "item_id", "text", bare_words(F.col("text")).alias("words")
    ).filter(F.size("words") > 0).dropDuplicates(["item"]).withColumn("telling", telling_places(F.col("words"), window)))
    return items, cut_lineage(template_windows(items, "item", window).withColumnsRenamed({"place": "item_place"}))


def counted_windows(aligned: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows (text_key, item, ``places``, ``telling`` and ``pairs``) with ``counted``, the places that count, and ``longest``, the most
    words in a row that differ by case at most. ``pairs`` has the words of item and text in lower case, one pair per word of the item.
    """

    def covered(at: Column) -> Column:
        return F.slice("pairs", at + 1, window)

    same = F.filter("places", lambda at: F.forall(covered(at), lambda p: p.a.eqNullSafe(p.b)))
    split = computed(aligned, "same", same)
    other = F.filter("places", lambda at: ~F.array_contains("same", at))
    runs = F.transform(other, lambda at: F.struct(F.size(F.filter("same", lambda s: s < at)).alias("run"), at.alias("at")))
    split = computed(split, "runs", runs)
    ids = F.array_distinct(F.transform("runs", lambda r: r.run))
    groups = F.transform(ids, lambda k: F.transform(F.filter("runs", lambda r: r.run == k), lambda r: r["at"]))
    split = computed(split, "groups", F.transform(groups, lambda g: F.struct(
        g.alias("at"), F.array_distinct(F.flatten(F.transform(g, covered))).alias("pairs")
    )))

    def consistent(g: Column) -> Column:
        n = F.size(g.pairs)
        left, right = F.transform(g.pairs, lambda p: p.a), F.transform(g.pairs, lambda p: p.b)
        return (F.size(F.array_distinct(left)) == n) & (F.size(F.array_distinct(right)) == n)

    kept = F.flatten(F.transform(F.filter("groups", consistent), lambda g: g["at"]))
    ends = F.filter("same", lambda at: ~F.array_contains("same", at + 1))
    begins = F.filter("same", lambda at: ~F.array_contains("same", at - 1))
    stretch = F.array_max(F.zip_with(ends, begins, lambda e, b: F.least(e + window, F.size("pairs")) - b))
    return split.select("text_key", "item", F.array_intersect(F.concat("same", kept), "telling").alias("counted"),
                        F.coalesce(stretch, F.lit(0)).alias("longest"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT, excerpt: int = EXCERPT
) -> DataFrame:
    """(text_key, item_id, n_windows, n_found): benchmark items held by a text, by the md5 of the text.

    n_windows counts the item's windows with a literal word (all, if no window has one), n_found those of them that count;
    ``100 * n_found >= percent * n_windows``, or ``excerpt`` words of
    the item stand in the text in a row, by case at most different. Null and empty texts and items hold nothing. Items that
    repeat are one; an item without an item_id is reported with a null one. Other columns are not read.
    """
    items, wanted = benchmark_windows(benchmark, window)
    texts = docs.filter(F.col("text").isNotNull()).select(F.md5("text").alias("text_key"), "text")
    hits = cut_lineage(
        join_small(template_windows(texts, "text_key", window), wanted, ["hash"], "inner", 32)
        .select("text_key", "item", "place", "item_place").distinct().withColumn("shift", F.col("place") - F.col("item_place"))
    )
    numbers = items.select("item", "item_id", F.size("telling").alias("n_windows"))
    enough = 100 * F.col("n_found") >= percent * F.col("n_windows")
    likely = hits.groupBy("text_key", "item").agg(F.count_distinct("item_place").alias("n_found"))
    likely = cut_lineage(join_small(likely, numbers, ["item"], "inner").filter(
        enough | (F.col("n_found") > excerpt - window)
    ).select("text_key", "item"))
    aligned = hits.join(likely, ["text_key", "item"]).groupBy("text_key", "item", "shift").agg(
        F.array_sort(F.collect_set("item_place")).alias("places")
    )
    some = join_small(texts, cut_lineage(likely.select("text_key").distinct()), ["text_key"], "inner")
    held = cut_lineage(some.dropDuplicates(["text_key"]).select("text_key", bare_words(F.lower("text")).alias("words")))
    lower = items.select("item", "telling", F.transform("words", lambda w: F.lower(w)).alias("item_words"))
    filled = join_small(aligned, lower, ["item"], "inner", 4096).join(held, "text_key")
    pairs = F.transform("item_words", lambda w, k: F.struct(
        w.alias("a"), F.when(k + F.col("shift") >= 0, F.get("words", k + F.col("shift"))).alias("b")
    ))
    counted = cut_lineage(counted_windows(computed(filled, "pairs", pairs), window))
    found = counted.select("text_key", "item", "longest", F.explode_outer("counted").alias("item_place")).groupBy(
        "text_key", "item"
    ).agg(F.count_distinct("item_place").alias("n_found"), F.max("longest").alias("longest"))
    return cut_lineage(join_small(found, numbers, ["item"], "inner").filter(enough | (F.col("longest") >= excerpt)).select(
        "text_key", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "n_found"
    ))


def leaked_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found): one row per document and item that it holds; see ``leaks``."""
    keyed = docs.select("doc_id", F.md5("text").alias("text_key"))
    return join_small(keyed, leaks(docs, benchmark, window, percent), ["text_key"], "inner", 128).drop("text_key")


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no benchmark item, null texts among them."""
    found = cut_lineage(leaks(docs, benchmark, window, percent).select(F.col("text_key").alias("_text_key")).distinct())
    return join_small(docs.withColumn("_text_key", F.md5("text")), found, ["_text_key"], "left_anti").drop("_text_key")
