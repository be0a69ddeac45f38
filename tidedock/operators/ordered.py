"""Operators that need a global order, without a window over everything in one task.

``value_parts`` range-partitions counted values; equal values have been merged into one counted row before,
so a value that holds a third of all rows is one row here.
``global_index`` numbers rows by a range-partitioned sort that is written once. ``blocked_window``
evaluates row windows in fixed blocks that carry the rows they need from their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock.staging import stage


def value_parts(counts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``counts`` written in the order of (keys, value), with the number ``part`` of its range partition.

    Parts follow that order, and their number and size follow the shuffle partitions, not a constant.
    """
    ranged = counts.repartitionByRange(*keys, value).withColumn("part", F.spark_partition_id())
    return stage(ranged, name)


def value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Written table ``(by..., v, n)`` of the non-null values and how often each occurs."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    return stage(rows.groupBy(*by, "v").agg(F.count("*").alias("n")), "value-counts")


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """Interpolated quantiles as columns ``q0``, ``q1``, ... in the order of ``probabilities``."""
    keys = by or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(1))
    found = count_quantiles(value_counts(rows, value, keys), probabilities, keys)
    return found if by else found.drop("_all")


def count_quantiles(counts: DataFrame, probabilities: list[float], keys: list[str]) -> DataFrame:
    """Quantiles of a written ``value_counts`` table by running counts inside and ahead of each range part."""
    parted = value_parts(counts, keys, "v", "value-parts")
    totals = parted.groupBy(*keys, "part").agg(F.sum("n").alias("bn"))
    ahead = W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "part",
        F.coalesce(F.sum("bn").over(ahead), F.lit(0)).alias("offset"),
        F.sum("bn").over(W.partitionBy(*keys)).alias("total"),
    )
    inside = W.partitionBy(*keys, "part").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    ranked = parted.join(offsets, [*keys, "part"]).withColumn("upto", F.col("offset") + F.sum("n").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("v")))

    picks = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("total") - 1)
        picks += [
            at(F.floor(position)).alias(f"_lo{i}"),
            at(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_f{i}"),
        ]
    return ranked.groupBy(*keys).agg(*picks).select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def global_index(df: DataFrame, order_by: list[str], name: str = "ordered") -> DataFrame:
    """The rows with their zero-based position ``idx`` in the total order of ``order_by``.

    The range partitioner cuts on the whole sort key, so one crowded timestamp is split as well.
    The sorted rows are written with their place inside the partition; partition sizes then give the
    offsets (one row per partition).
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    written = stage(placed, name)
    part = F.shiftright("_place", 33)
    rows = written.withColumn("_part", part).withColumn("_pos", F.col("_place") - F.shiftleft(part, 33))
    sizes = rows.groupBy("_part").agg(F.max("_pos").alias("m"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum(F.col("m") + 1).over(ahead), F.lit(0)).alias("_offset"))
    # One row per written partition: bounded by the shuffle partition count.
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn("idx", F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_place", "_offset")
    )


def blocked_window(
    indexed: DataFrame,
    before: int,
    after: int,
    windows: Callable[[DataFrame, WindowSpec], DataFrame],
    keys: list[str] | None = None,
    block_rows: int = 100_000,
) -> DataFrame:
    """Row windows over ``idx`` in blocks of fixed size, equal to windows over whole groups.

    ``windows`` adds its columns to the rows using the given order. Each block also receives the ``before`` rows ahead of it and the ``after`` rows behind it, which are
    dropped after use. With ``keys`` (the leading columns of the order that gave ``idx``) a window never
    leaves its group, and a group of any size is spread over as many blocks as it fills.
    """
    if block_rows <= before + after:
        raise ValueError("a block must be larger than the window")
    block = (F.col("idx") / block_rows).cast("long")
    place = F.pmod("idx", F.lit(block_rows))
    own = F.col("_own")
    targets = F.filter(
        F.array(
            F.when(place < after, own - 1),
            own,
            F.when(place >= block_rows - before, own + 1),
        ),
        lambda b: b.isNotNull(),
    )
    spread = indexed.withColumn("_own", block).withColumn("_block", F.explode(targets))
    order = W.partitionBy("_block", *(keys or [])).orderBy("idx")
    return windows(spread, order).where(F.col("_own") == F.col("_block")).drop("_own", "_block")


def keyed_windows(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    before: int,
    after: int,
    windows: Callable[[DataFrame, WindowSpec], DataFrame],
    block_rows: int = 100_000,
) -> DataFrame:
    """Row windows per key for frames in which a single key may hold any share of the rows."""
    indexed = global_index(df, [*keys, *order_by], "keyed")
    return blocked_window(indexed, before, after, windows, keys, block_rows).drop("idx")
