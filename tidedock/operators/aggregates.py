"""Exploratory and dashboard aggregations. Each is one hash aggregation with map-side combine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions import labels
from tidedock.functions.stats import bin_index
from tidedock.functions.timefns import in_date_range
from tidedock.operators.ordered import count_quantiles, value_counts
from tidedock.staging import stage_small

VALUE = "num_bikes_available"


def hourly_availability(df: DataFrame) -> DataFrame:
    out = df.groupBy("hour", "is_weekend").agg(F.avg(VALUE).alias("avg_bikes"))
    return out.withColumn("day_type", labels.day_type(F.col("is_weekend")))


def station_summary(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Load per station with the first non-null place and capacity in time order."""

    def first(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(time_col))).alias(column)

    out = df.groupBy("station_id").agg(
        F.avg(VALUE).alias("avg_bikes"),
        F.min(VALUE).alias("min_bikes"),
        F.max(VALUE).alias("max_bikes"),
        first("lat"),
        first("lon"),
        first("capacity"),
    )
    return out.withColumn("fill_pct", labels.fill_pct(F.col("avg_bikes"), F.col("capacity")))


def station_summary_at_hour(df: DataFrame, hour: int) -> DataFrame:
    return station_summary(df.where(F.col("hour") == hour))


def weekday_hour_heatmap(df: DataFrame) -> DataFrame:
    """Weekday rows by 24 fixed hour columns ``h00`` to ``h23``, empty cells 0."""
    columns = [
        F.coalesce(F.avg(F.when(F.col("hour") == h, F.col(VALUE))), F.lit(0.0)).alias(f"h{h:02d}")
        for h in range(24)
    ]
    return df.groupBy("weekday").agg(*columns)


def peak_hour_kpis(df: DataFrame) -> DataFrame:
    """Day-type means of the hourly means, and the hours with the fewest and the most bikes."""
    hourly = hourly_availability(df)
    row = F.struct("hour", "avg_bikes", "day_type")
    fewest = F.struct("avg_bikes", "hour", "is_weekend")
    most = F.struct("avg_bikes", -F.col("hour"), -F.col("is_weekend"))
    kpis = hourly.agg(
        F.avg(F.when(F.col("day_type") == "Weekday", F.col("avg_bikes"))).alias("weekday_avg"),
        F.avg(F.when(F.col("day_type") == "Weekend", F.col("avg_bikes"))).alias("weekend_avg"),
        F.min_by(row, fewest).alias("busiest"),
        F.max_by(row, most).alias("quietest"),
    )
    return kpis.select(
        "weekday_avg",
        "weekend_avg",
        labels.hour_label(F.col("busiest.hour")).alias("busiest_hour"),
        F.col("busiest.avg_bikes").alias("busiest_avg_bikes"),
        labels.hour_label(F.col("quietest.hour")).alias("quietest_hour"),
        F.col("quietest.avg_bikes").alias("quietest_avg_bikes"),
    )


def fleet_kpis_at_hour(df: DataFrame, hour: int) -> DataFrame:
    """Centre of the fleet, station count, mean of station means and mean fill at one hour."""
    return station_summary_at_hour(df, hour).agg(
        F.avg("lat").alias("center_lat"),
        F.avg("lon").alias("center_lon"),
        F.count("*").alias("n_stations"),
        F.avg("avg_bikes").alias("avg_bikes_per_station"),
        F.avg("fill_pct").alias("avg_fill_pct"),
    )


def availability_timeline(df: DataFrame, first_day: str, last_day: str, time_col: str = "timestamp") -> DataFrame:
    rows = df.where(in_date_range(F.col(time_col), first_day, last_day))
    return rows.select("station_id", time_col, VALUE)


def station_means_in_range(df: DataFrame, first_day: str, last_day: str, time_col: str = "timestamp") -> DataFrame:
    rows = availability_timeline(df, first_day, last_day, time_col)
    return rows.groupBy("station_id").agg(F.avg(VALUE).alias("avg_bikes"))


def snapshot_totals(latest: DataFrame) -> DataFrame:
    bikes, docks = F.sum("num_bikes_available"), F.sum("num_docks_available")
    return latest.agg(
        F.count("*").alias("total_stations"),
        F.count_if("is_renting").alias("renting"),
        F.count_if("is_returning").alias("returning"),
        (F.count("*") - F.count_if("is_renting")).alias("not_renting"),
        bikes.alias("total_bikes"),
        docks.alias("total_docks"),
        (F.try_divide(bikes, bikes + docks) * 100).alias("occupancy_pct"),
    )


def value_range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("r"))


def histogram(df: DataFrame, value: str, n_bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width counts over the whole value range; bins are shared by all groups.

    Null and NaN are left out. All ``n_bins`` bins appear, for every group, with 0 where nothing falls. Each row is counted
    once; only the counts meet the range.
    """
    rows = df.withColumn("_v", labels.null_if_nan(F.col(value).cast("double"))).where(F.col("_v").isNotNull())
    keys = [by] if by else []
    # The range travels as one constant column: a single subquery, however often it is used.
    ranged = rows.select(*keys, "_v", value_range(rows, "_v").scalar().alias("_r"))
    index = bin_index(F.col("_v"), F.col("_r.lo"), F.col("_r.hi"), n_bins)
    counted = ranged.groupBy(*keys, index.alias("bin")).agg(F.count("*").alias("n"), F.first("_r").alias("_r"))
    # The per-group bin counts are a map of at most n_bins entries.
    packed = counted.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.first("_r").alias("_r")
    )
    bins = packed.select(*keys, "m", "_r", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    lo, width = F.col("_r.lo"), (F.col("_r.hi") - F.col("_r.lo")) / F.lit(float(n_bins))
    return bins.select(
        *keys,
        "bin",
        (lo + F.col("bin") * width).alias("bin_low"),
        (lo + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("long").alias("n"),
    )


#: Per pair of columns: rows with both, sums, sums of squares and of products; least (negated) and greatest values.
_MOMENTS = ["n", "x", "y", "xx", "yy", "xy", "x_low", "y_low", "x_high", "y_high"]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every unordered pair over the rows that have both values.

    Every task adds up one set of moment matrices of its rows, about the means of a first pass, so that large means cost no digits;
    matrices merge by sum, and a row never leaves its task.
    Columns without variation give null, null and NaN are missing.
    """
    columns = columns or [*schemas.FEATURE_COLS, schemas.TARGET_COL]
    rows = df.select(*[labels.null_if_nan(F.col(c).cast("double")).alias(c) for c in columns])
    first = rows.agg(*[F.avg(c) for c in columns]).first()
    shift = np.array([0.0 if m is None else m for m in first])
    i, j = np.triu_indices(len(columns), 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.array([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]).T - shift
            here = ~np.isnan(x)
            z, m = np.where(here, x, 0.0), here.astype(float)
            sums, squares = z.T @ m, (z * z).T @ m  # of a row's column where the other is present
            low = np.array([np.where(here & here[:, [k]], x, np.inf).min(0, initial=np.inf) for k in range(len(columns))])
            high = np.array([np.where(here & here[:, [k]], x, -np.inf).max(0, initial=-np.inf) for k in range(len(columns))])
            part = [
                (m.T @ m)[i, j], sums[i, j], sums[j, i], squares[i, j], squares[j, i], (z.T @ z)[i, j],
                -low[j, i], -low[i, j], high[j, i], high[i, j],
            ]
            total = part if total is None else [*map(np.add, total[:6], part[:6]), *map(np.maximum, total[6:], part[6:])]
        if total is not None:
            yield pa.record_batch([pa.array([v.tolist()], pa.list_(pa.float64())) for v in total], names=_MOMENTS)

    found = rows.mapInArrow(moments, ", ".join(f"{c} array<double>" for c in _MOMENTS))
    cells = found.select(F.posexplode(F.arrays_zip(*_MOMENTS)).alias("pair", "v")).groupBy("pair").agg(
        *[F.sum(f"v.{c}").alias(c) for c in _MOMENTS[:6]], *[F.max(f"v.{c}").alias(c) for c in _MOMENTS[6:]]
    )
    n = F.col("n")
    both = F.col("xy") - F.col("x") * F.col("y") / n
    spread = F.sqrt((F.col("xx") - F.col("x") * F.col("x") / n) * (F.col("yy") - F.col("y") * F.col("y") / n))
    varies = (n > 0) & (-F.col("x_low") < F.col("x_high")) & (-F.col("y_low") < F.col("y_high"))
    names = F.array(*[F.struct(F.lit(columns[a]).alias("a"), F.lit(columns[b]).alias("b")) for a, b in zip(i, j)])
    every = df.sparkSession.range(len(i)).select(F.col("id").cast("int").alias("pair"))
    return every.join(cells, "pair", "left").select(
        F.get(names, F.col("pair"))["a"].alias("column_a"),
        F.get(names, F.col("pair"))["b"].alias("column_b"),
        F.when(varies, F.try_divide(both, spread)).alias("correlation"),
    )


def target_correlation(df: DataFrame, target: str = schemas.TARGET_COL) -> DataFrame:
    """Correlation of each feature with the target, strongest positive first."""
    pairs = correlation_matrix(df, [*schemas.FEATURE_COLS, target]).where(F.col("column_b") == target)
    rows = pairs.select(F.col("column_a").alias("feature"), "correlation")
    return rows.orderBy(F.col("correlation").desc_nulls_last(), "feature")


def feature_summary(long: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of ``value`` per group.

    The rows are read once and counted per value; all statistics come from the written counts.
    """
    counts = value_counts(long, "value", by)
    n, v = F.col("n"), F.col("v")
    centre = stage_small(
        counts.groupBy(*by).agg(
            F.sum("n").alias("rows"),
            (F.sum(v * n) / F.sum("n")).alias("mean"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        ),
        "value-centres",
    )
    squares = counts.join(centre, by).groupBy(*by).agg(
        F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("m2")
    )
    quartiles = count_quantiles(counts, [0.25, 0.5, 0.75], by)
    named = quartiles.withColumnsRenamed({"q0": "q25", "q1": "median", "q2": "q75"})
    std = F.sqrt(F.try_divide(F.col("m2"), F.col("rows") - 1))
    return centre.join(squares, by).join(named, by).select(
        *by, F.col("rows").alias("n"), "mean", std.alias("std"), "min", "q25", "median", "q75", "max"
    )


def feature_summary_delta(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Statistics of both sides and their difference, one row per feature and statistic."""
    from tidedock.operators.drift import two_sides

    return summary_delta(two_sides(reference, current, features))


def summary_delta(long: DataFrame) -> DataFrame:
    """The same from long rows ``(feature, value, ref, cur)``."""
    side = F.when(F.col("ref") == 1, "reference").otherwise("current").alias("side")
    stats = ["count", "mean", "std", "min", "q25", "median", "q75", "max"]
    summary = feature_summary(long.select("feature", "value", side), ["feature", "side"])
    summary = summary.withColumn("count", F.col("n").cast("double"))
    rows = summary.unpivot(["feature", "side"], stats, "metric", "value")
    pick = lambda name: F.max(F.when(F.col("side") == name, F.col("value")))
    out = rows.groupBy("feature", "metric").agg(pick("reference").alias("reference"), pick("current").alias("current"))
    return out.withColumn("delta", F.col("current") - F.col("reference"))
