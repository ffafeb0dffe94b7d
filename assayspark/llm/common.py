"""Helpers of the corpus operators: words, bounded broadcasts, linked groups, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayspark.operators import scale
from assayspark.operators.scale import BROADCAST_BYTES, measured, null_safe_join, scratch_folder

__all__ = ["components", "computed", "cut_lineage", "join_small", "null_safe_join", "scratch_folder", "table",
           "words"]

BLANKS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows handed to a Python worker at once.
BATCH_ROWS = 2048
#: The operator whose tasks this Python worker ran last, and what gives back its memory.
_worker: tuple[str, Callable[[], None]] = ("", lambda: None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space; an empty array for null."""
    found = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once per row.

    A plain column would be put back in place of its name by the optimizer, also inside a lambda, which would work it out anew
    for every element. A generator of one row stands in between.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def join_small(rows: DataFrame, small: DataFrame, on: list[str], how: str = "left", row_bytes: int = 64) -> DataFrame:
    """NULL-safe join with a table that is usually small.

    ``small`` must be cheap to measure (a written table). Its bytes, as measured, and ``row_bytes`` for each row decide: up to
    BROADCAST_BYTES it is broadcast, beyond that Spark shuffles both sides and splits skewed keys.
    """
    n, size = measured(small)
    fits = size + n * row_bytes <= BROADCAST_BYTES
    return null_safe_join(rows, F.broadcast(small) if fits else small, on, how)


def fresh_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def take_worker(operator: str, forget: Callable[[], None] = lambda: None) -> None:
    """Say in a Python worker, at the start of a task, whose it is; ``forget`` gives back what the task leaves for those after it.

    Spark goes on using its workers, so what an operator remembers between its tasks goes when another operator's begin.
    """
    global _worker
    if _worker[0] != operator:
        _worker[1]()
    _worker = operator, forget


@contextmanager
def _with_conf(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def small_batches(spark: SparkSession):
    """Meanwhile Python workers get batches of BATCH_ROWS rows, as whole texts may be long."""
    return _with_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder, handed to Python workers in small batches; the shuffle files behind it go when
    it is complete.
    """
    spark = df.sparkSession
    with small_batches(spark), _with_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return scale.cut_lineage(df)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label of each linked node: (node, component), component being the smallest node reachable.

    Alternates two star steps over the edges until nothing moves: every node's larger neighbours go
    to its smallest neighbour, then its smaller ones do. A minimum per node is combined before the
    shuffle, so a hub's edges never meet in one task; each round is a written table.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = cut_lineage(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = cut_lineage(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, mark, now = mark, _mark(following), following
        if mark == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Row count and checksum, which change whenever the edges do."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
