"""Stored daily profiles: what drift checks and summaries need of a day, written once and merged for any range of days.

A day is profiled in two forms. *Counts* hold every distinct value of a feature with its number of rows, so that all
measures of `drift` come out as from the rows themselves. *Sketches* hold, per feature, the row count, extremes, sums
and a KLL quantile and an HLL distinct-count sketch, a few kilobytes whatever the number of rows. Both merge by
plain aggregation, so a monitoring run over years reads profiles of old days and rows of new ones only.

Null and NaN are no values. Days are those of the column as it is given; rows without a time belong to the day null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions import labels
from tidedock.operators import drift

#: Size parameter of the quantile sketch: a normalised rank error well below 1 % for single quantiles.
KLL_K = 800
#: Base-two logarithm of the number of registers of the distinct-count sketch: a relative deviation of about 1.6 %.
HLL_LG_K = 12


def daily_values(rows: DataFrame, features: list[str], time_col: str = "timestamp") -> DataFrame:
    """Long form ``(day, feature, value)``."""
    schemas.require_columns(rows, [*features, time_col])
    wide = rows.select(
        F.to_date(time_col).alias("day"), *[labels.null_if_nan(F.col(c).cast("double")).alias(c) for c in features]
    )
    return wide.unpivot(["day"], features, "feature", "value").where(F.col("value").isNotNull())


def daily_counts(rows: DataFrame, features: list[str] = schemas.FEATURE_COLS, time_col: str = "timestamp") -> DataFrame:
    """``(day, feature, value, n)``: one hash aggregation with map-side combine."""
    return daily_values(rows, features, time_col).groupBy("day", "feature", "value").agg(F.count("*").alias("n"))


def sides(profiles: DataFrame, reference: Column, current: Column) -> DataFrame:
    """Long form ``(feature, value, ref, cur)`` of the days that ``reference`` and ``current`` choose.

    The condition on ``day`` reaches the partitions of a stored table. A day may be on both sides.
    """
    chosen = profiles.where(reference | current)
    count = lambda side: F.sum(F.when(side, F.col("n")).otherwise(0))
    return chosen.groupBy("feature", "value").agg(count(reference).alias("ref"), count(current).alias("cur"))


def feature_drift_from_profiles(profiles: DataFrame, reference: Column, current: Column) -> DataFrame:
    """The rows of `drift.feature_drift` from stored counts instead of facts."""
    compared = drift.compare_distributions(sides(profiles, reference, current))
    return drift.with_verdict(compared, drift.PSI_THRESHOLD, drift.KS_ALPHA)


def daily_sketches(
    rows: DataFrame, features: list[str] = schemas.FEATURE_COLS, time_col: str = "timestamp",
    k: int = KLL_K, lg_k: int = HLL_LG_K,
) -> DataFrame:
    """``(day, feature, n, total, lo, hi, quantiles, distinct)`` with two binary sketches."""
    return daily_values(rows, features, time_col).groupBy("day", "feature").agg(
        F.count("*").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.kll_sketch_agg_double("value", F.lit(k)).alias("quantiles"),
        F.hll_sketch_agg(F.col("value").cast("string"), F.lit(lg_k)).alias("distinct"),
    )


def merged_summary(sketches: DataFrame, by: list[str], k: int = KLL_K, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean and extremes exactly, quantiles and distinct count estimated, per group of ``by`` columns."""
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(k)).alias("_q"),
        F.hll_union_agg("distinct").alias("_d"),
    )
    names = [f"q{round(100 * q)}" for q in quantiles]
    return merged.select(
        *by, "n", (F.col("total") / F.col("n")).alias("mean"), "min", "max",
        *[F.kll_sketch_get_quantile_double("_q", F.lit(q)).alias(name) for q, name in zip(quantiles, names)],
        F.hll_sketch_estimate("_d").alias("n_distinct"),
    )


def quantiles_within(
    summary: DataFrame, counts: DataFrame, tolerance: float, columns: list[tuple[str, float]] = [("q25", 0.25), ("q50", 0.5), ("q75", 0.75)],
) -> DataFrame:
    """``summary`` per feature with a flag per quantile: does its exact rank in ``counts`` differ by at most ``tolerance``."""
    joined = counts.join(summary.select("feature", *[c for c, _ in columns]), "feature")
    share = lambda hit: F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.sum("n")
    flags = [
        (
            (share(F.col("value") < F.col(c)) <= q + tolerance) & (share(F.col("value") <= F.col(c)) >= q - tolerance)
        ).alias(f"{c}_within")
        for c, q in columns
    ]
    return summary.join(joined.groupBy("feature").agg(*flags), "feature")
