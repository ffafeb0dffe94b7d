"""Helpers that keep a hot key from landing in one task.

``attach`` joins a per-key summary back to rows; ``in_slices`` and ``running`` give ordered
running totals per key when one key may hold a third of all rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
#: What a field takes besides the bytes of its text.
FIELD_BYTES = 16
#: Rows of one key that a task may get; a key with more is cut into as many pieces as that takes.
ROWS_PER_PIECE = 1_000_000
#: Rows that a task sorts for a window over slices, on average.
ROWS_PER_TASK = 125_000
SLICE = "_slice"
SALT = "_salt"


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder under the cluster's shared checkpoint folder."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="assayspark-"))
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/assayspark-{context.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Later stages start from files, so they survive a lost executor, know the true size and read only
    the columns they need. Iterations stay cheap to plan, as a plain table carries no constraints.
    """
    path = f"{scratch_folder(df.sparkSession)}/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the written table behind ``df``, once every table worked out from it is written too."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if scratch_folder(spark).rsplit("/", 1)[-1] not in path.split("/"):
            raise ValueError(f"{path} is no table of this application")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which a NULL key meets a NULL key; the key columns come from the left."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a written table, by the lengths of its texts and nested values; each field counts FIELD_BYTES more."""
    width = F.lit(0)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        width = width + FIELD_BYTES
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return found["n"], found["bytes"] or 0


def fits_broadcast(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small enough to be sent to every executor, as measured."""
    n, size = measured(df)
    return n <= most_rows and size <= BROADCAST_BYTES


def attach(
    rows: DataFrame,
    summary: DataFrame,
    on: list[str],
    how: str = "left",
    rows_per_key: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join at most one summary row per key to the rows, whatever the size of a key.

    The summary is materialised and measured. Up to ``broadcast_rows`` and BROADCAST_BYTES it is broadcast, so the rows
    are not shuffled; beyond, the most frequent keys are salted. ``rows_per_key`` names a summary
    column with the key's row count, which saves counting them; it does not reach the result.
    """
    kept = cut_lineage(summary)
    return join_summary(rows, kept, on, how, fits_broadcast(kept, broadcast_rows), rows_per_key)


def join_summary(
    rows: DataFrame, kept: DataFrame, on: list[str], how: str, small: bool, rows_per_key: str | None = None
) -> DataFrame:
    """``attach`` for a materialised summary of known size class."""
    wanted = kept.drop(rows_per_key) if rows_per_key else kept
    if small:
        return null_safe_join(rows, F.broadcast(wanted), on, how)
    if rows_per_key:
        counts = kept.select(*on, F.col(rows_per_key).alias("_rows"))
    else:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    # At most one heavy key per ROWS_PER_PIECE rows. Equal rows of a key spread too, as the salt comes from their place.
    pieces = F.ceil(F.col("_rows") / ROWS_PER_PIECE).cast("int").alias("_pieces")
    heavy = cut_lineage(counts.filter(F.col("_rows") > ROWS_PER_PIECE).select(*on, pieces))
    number = F.coalesce("_pieces", F.lit(1))
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    salted = null_safe_join(placed, F.broadcast(heavy), on).withColumn(
        SALT, F.pmod(F.col("_place"), number).cast("int")
    ).drop("_pieces", "_place")
    copies = null_safe_join(wanted, F.broadcast(heavy), on).withColumn(
        SALT, F.explode(F.sequence(F.lit(0), number - 1))
    ).drop("_pieces")
    return null_safe_join(salted, copies, [*on, SALT], how).drop(SALT)


def session_partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions. Named in a repartition, adaptive execution does not merge them by compressed bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_slices(df: DataFrame, keys: list[str], order: list[str], pieces: int | None = None) -> DataFrame:
    """Range-partition by key and order column and number the partitions.

    The order column is part of the range key, so a hot key spreads over many slices. Sampled range
    bounds may differ between two runs, hence the written table: every reader sees the same slices.
    ``pieces`` is the number of slices of a table that may be large; without it Spark merges small ones.
    """
    ranged = df.repartitionByRange(*([pieces] if pieces else []), *keys, *order).withColumn(SLICE, F.spark_partition_id())
    return cut_lineage(ranged)


def by_slice(sliced: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a written table of slices, each key's slice whole, in as many tasks as the rows take."""
    return sliced.repartition(max(1, -(-sliced.count() // ROWS_PER_TASK)), *keys, SLICE)


def running(
    sliced: DataFrame,
    keys: list[str],
    order: list[str],
    sums: Mapping[str, str] | None = None,
    mins: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    from_top: bool = False,
) -> DataFrame:
    """Add inclusive running sums and minima, and key totals (``new name -> column``), in order.

    ``sliced`` comes from ``in_slices`` with the same keys; ``order`` starts with its order columns
    and is unique within a key. Each window holds one slice of one key; the windows over slice
    totals hold at most one row per slice.
    """
    sums, mins, totals = dict(sums or {}), dict(mins or {}), dict(totals or {})
    step = F.desc if from_top else F.asc
    per_slice = sliced.groupBy(*keys, SLICE).agg(
        *[F.sum(c).alias(f"_off_{o}") for o, c in (sums | totals).items()],
        *[F.min(c).alias(f"_off_{o}") for o, c in mins.items()],
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(step(SLICE))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    offsets = per_slice.select(
        *keys, SLICE,
        *[F.sum(f"_off_{o}").over(earlier).alias(f"_off_{o}") for o in sums],
        *[F.min(f"_off_{o}").over(earlier).alias(f"_off_{o}") for o in mins],
        *[F.sum(f"_off_{o}").over(whole).alias(o) for o in totals],
    )
    within = (
        Window.partitionBy(*keys, SLICE).orderBy(*[step(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = by_slice(sliced, keys).withColumns({
        **{o: F.sum(c).over(within) for o, c in sums.items()},
        **{o: F.min(c).over(within) for o, c in mins.items()},
    })
    joined = null_safe_join(local, offsets, [*keys, SLICE])
    return joined.withColumns({
        **{o: F.col(o) + F.coalesce(F.col(f"_off_{o}"), F.lit(0)) for o in sums},
        **{o: F.least(F.col(o), F.col(f"_off_{o}")) for o in mins},
    }).drop(*[f"_off_{o}" for o in (*sums, *mins)])


def placed_rows(df: DataFrame, keys: list[str], value: str, pieces: int | None = None) -> DataFrame:
    """The rows in slices, with ``_before`` (rows of the key with a smaller value), ``_ties`` (rows with the same), ``_dense``
    (distinct values up to this one) and ``_all`` (rows of the key).

    Rows ride along: they are dealt out by key, value and their own place, so one value spreads over as many slices as it takes,
    and nothing is joined on a value. A slice is described by its size and its first and last value; only these can go on
    in a neighbour. The rows meet the descriptions by key and slice. The value must not be NULL.
    ``pieces`` is for ``in_slices``.
    """
    sliced = in_slices(df.withColumn("_place", F.monotonically_increasing_id()), keys, [value, "_place"], pieces).drop("_place")
    tallied = sliced.groupBy(*keys, SLICE, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    edge = F.struct("_value", "_n")
    slices = tallied.groupBy(*keys, SLICE).agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_distinct"), F.min(edge).alias("_first"), F.max(edge).alias("_last"),
    )
    # At most one row per key and slice from here on.
    in_order = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag("_last._value").over(in_order) == F.col("_first._value"), F.lit(False))
    slices = slices.withColumns({
        "_offset": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)), "_goes_on": goes_on.cast("bigint"),
        "_all": F.sum("_rows").over(Window.partitionBy(*keys)),
    }).withColumn(
        "_distinct_offset", F.coalesce(F.sum(F.col("_distinct") - F.col("_goes_on")).over(earlier), F.lit(0)) - F.col("_goes_on")
    )
    ends = F.array_distinct(F.array(
        F.struct(F.col("_first._value").alias("value"), F.col("_offset").alias("start"), F.col("_first._n").alias("n")),
        F.struct(F.col("_last._value").alias("value"), (F.col("_offset") + F.col("_rows") - F.col("_last._n")).alias("start"),
                 F.col("_last._n").alias("n")),
    ))
    edges = slices.select(*keys, F.explode(ends).alias("_end")).groupBy(*keys, F.col("_end.value").alias("_value")).agg(
        F.min("_end.start").alias("_start"), F.sum("_end.n").alias("_total")
    )
    described = slices.select(
        *keys, SLICE, "_all", "_offset", "_distinct_offset", F.col("_first._value").alias("_low"), F.col("_last._value").alias("_high")
    )
    for end in ("_low", "_high"):
        own = edges.select(*keys, F.col("_value").alias(end), F.struct("_start", "_total").alias(f"{end}_ties"))
        described = null_safe_join(described, own, [*keys, end])
    part = Window.partitionBy(*keys, SLICE)
    local = by_slice(sliced, keys).withColumns({
        "_smaller": F.rank().over(part.orderBy(value)) - 1, "_seen": F.dense_rank().over(part.orderBy(value)),
        "_same": F.count(F.lit(1)).over(Window.partitionBy(*keys, SLICE, value)),
    })
    joined = null_safe_join(local, described, [*keys, SLICE], "inner")

    def at_edge(field: str, inside: Column) -> Column:
        return F.when(F.col(value) == F.col("_low"), F.col(f"_low_ties.{field}")).when(
            F.col(value) == F.col("_high"), F.col(f"_high_ties.{field}")
        ).otherwise(inside)

    return joined.withColumns({
        "_before": at_edge("_start", F.col("_offset") + F.col("_smaller")), "_ties": at_edge("_total", F.col("_same")),
        "_dense": F.col("_distinct_offset") + F.col("_seen"),
    }).drop("_smaller", "_seen", "_same", "_offset", "_distinct_offset", "_low", "_high", "_low_ties", "_high_ties")


def average_ranks(
    df: DataFrame, keys: list[str], value: str, counts: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """One row per key and distinct value: count ``n``, rows up to it ``upto`` and tie-averaged ``rank``.

    ``counts`` names columns of ``df`` to sum per distinct value as well. ``weight`` names the number of rows that a row stands for.
    """
    present = df.filter(F.col(value).isNotNull())
    tallied = present.groupBy(*keys, value).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("n"), *[F.sum(c).alias(c) for c in counts or []]
    )
    ranked = running(in_slices(tallied, keys, [value]), keys, [value], sums={"upto": "n"})
    return ranked.drop(SLICE).withColumn("rank", F.col("upto") - F.col("n") + (F.col("n") + 1) / 2)
