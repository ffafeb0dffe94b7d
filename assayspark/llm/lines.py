"""Line dedup by winnowing.

Every ``run`` neighbouring lines form a window, and so do fewer lines that hold LONG words or more. The line with the
smallest hash is the window's mark, so equal windows share one. All windows are written; those whose mark stands at one place only
are left out, the others are grouped by their content. Merged windows make the repeated runs. The first occurrence,
by doc_id and line, stays; lines of later ones are deleted. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import computed, cut_lineage, null_safe_join, words

RUN = 3
#: Words from which fewer lines than RUN are compared too.
LONG = 50


def text_lines(text: Column) -> Column:
    """Lines between line feeds; none for null, one empty line for an empty text."""
    return F.coalesce(F.split(text, "\n", -1), F.array().cast("array<string>"))


def _line_hash(salt: int):
    return lambda line: F.xxhash64(F.lit(salt), line)


def fingerprints(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """One row per window: doc_id, line (of its first line), lines, mark (its smallest line hash), spot (the line of the mark), key
    and check (its content).

    A text of fewer lines than ``run`` is one window, and so are fewer lines than ``run`` with ``long`` words or more.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    split = computed(named, "lines", text_lines(F.col("text")))
    each = F.struct(
        F.transform("lines", _line_hash(1)).alias("one"), F.transform("lines", _line_hash(2)).alias("two"),
        F.transform("lines", lambda line: F.size(words(line))).alias("words"),
    )
    hashed = computed(split, "hashes", each).select("doc_id", "hashes.one", "hashes.two", "hashes.words").filter("size(one) > 0")
    total = F.size("one")

    def starts(lines: int) -> Column:
        return F.sequence(F.lit(0), F.greatest(total - lines, F.lit(0)))

    def window(lines: int):
        def at_line(at: Column) -> Column:
            own = F.slice("one", at + 1, lines)
            mark = F.array_min(own)
            return F.struct(
                at.alias("line"), F.least(total, F.lit(lines)).alias("lines"), mark.alias("mark"),
                (at + F.array_position(own, mark).cast("int") - 1).alias("spot"), F.xxhash64(own).alias("key"),
                F.xxhash64(F.slice("two", at + 1, lines)).alias("check"),
            )
        return at_line

    def wordy(lines: int):
        return lambda at: (total > lines) & (sum(F.get("words", at + k) for k in range(lines)) >= long)

    short = [F.transform(F.filter(starts(n), wordy(n)), window(n)) for n in range(1, run)]
    return hashed.select("doc_id", F.inline(F.concat(F.transform(starts(run), window(run)), *short)))


def later_repeats(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """(doc_id, windows): first line and number of lines of the windows that occur at an earlier place too, in order."""
    windows = cut_lineage(fingerprints(docs, run, long))
    place, spot = F.struct("doc_id", "line"), F.struct("doc_id", "spot")
    marks = windows.groupBy("mark").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
    repeated = windows.join(marks.filter("first != last").select("mark"), "mark", "left_semi")
    first = repeated.groupBy("key", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    later = repeated.join(first.filter("n > 1").drop("n"), ["key", "check"]).filter(place > F.col("first"))
    return later.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("line", "lines"))).alias("windows"))


def delete_repeated_runs(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """The documents with lines_total, lines_removed, runs_removed and lines_kept, the text that is left.

    A line goes if it lies in a run of ``run`` equal lines, or of fewer with ``long`` words or more, that also starts at an earlier
    (doc_id, line); texts with fewer lines and words are compared as wholes with one another. Null texts have no lines and keep null; if all lines go, the text left is
    empty. A row without a doc_id is neither compared nor changed; rows that repeat a doc_id are at one place, so
    none is later than another. Columns of these four names are replaced; names that start with an underscore are used inside.
    """
    starts = cut_lineage(later_repeats(docs, run, long)).withColumnRenamed("windows", "_starts")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("lines_total", "lines_removed", "runs_removed", "lines_kept")]
    joined = computed(null_safe_join(docs.select(*own), starts.hint("merge"), ["doc_id"]), "_lines", text_lines(F.col("text")))
    total = F.size("_lines")
    none = F.array().cast("array<int>")
    covered = F.flatten(F.transform("_starts", lambda s: F.sequence(s.line, F.least(s.line + s.lines, total) - 1)))
    marked = computed(joined, "_gone", F.coalesce(F.array_distinct(covered), none))
    followed = F.transform("_gone", lambda line: line + 1)
    left = F.when(total > 0, F.array_except(F.sequence(F.lit(0), F.greatest(total, F.lit(1)) - 1), "_gone")).otherwise(none)
    kept = F.transform(left, lambda line: F.element_at("_lines", line + 1))
    return marked.withColumns({
        "lines_total": total.cast("long"), "lines_removed": F.size("_gone").cast("long"),
        "runs_removed": F.size(F.array_except("_gone", followed)).cast("long"),
        "lines_kept": F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")),
    }).drop("_starts", "_lines", "_gone")
