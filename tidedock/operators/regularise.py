"""Irregular reports to a regular time grid with bounded forward fill.

Scale: raw rows are reduced map-side to one row per (station, bin), so a station that holds a third of
the raw rows leaves the first shuffle with at most ``time span / freq`` rows (35,040 per year at 15
minutes). Everything after that is a window over stations with this bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions.timefns import GRID, interval, whole_days_between

FILL_STEPS = 4  # fixed value: one hour of 15-minute bins


def min_history(df: DataFrame, min_days: int = 7, key: str = "station_id", time_col: str = "last_reported") -> DataFrame:
    """Rows of keys whose first and last row are at least ``min_days`` whole days apart."""
    span = whole_days_between(F.min(time_col), F.max(time_col))
    keep = df.groupBy(key).agg(span.alias("_days")).where(F.col("_days") >= min_days)
    return df.join(keep.select(key), key, "left_semi")


def station_spans(df: DataFrame, key: str = "station_id", time_col: str = "last_reported") -> DataFrame:
    return df.groupBy(key).agg(whole_days_between(F.min(time_col), F.max(time_col)).alias("whole_days"))


def bin_status(
    df: DataFrame,
    freq: str = GRID,
    time_col: str = "last_reported",
    key: str = "station_id",
    means: list[str] = schemas.COUNT_COLS,
    lasts: list[str] | None = None,
) -> DataFrame:
    """Occupied bins only: mean of the counts, last non-null value of the other columns.

    ``first_seen``/``last_seen`` keep the raw time range of each bin for history filters.
    """
    if lasts is None:
        lasts = [c for c in (*schemas.FLAG_COLS, *schemas.STATIC_COLS) if c in df.columns]
    schemas.require_columns(df, [key, time_col, *means, *lasts])
    binned = df.groupBy(key, F.window(time_col, freq).alias("_bin")).agg(
        *[F.avg(c).alias(c) for c in means],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time_col))).alias(c) for c in lasts],
        F.min(time_col).alias("first_seen"),
        F.max(time_col).alias("last_seen"),
    )
    kept = [c for c in binned.columns if c not in (key, "_bin")]
    return binned.select(key, F.col("_bin.start").alias("timestamp"), *kept)


def fill_forward(
    bins: DataFrame, freq: str = GRID, steps: int = FILL_STEPS, key: str = "station_id", min_days: int | None = None
) -> DataFrame:
    """Repeat every bin into the empty bins after it, at most ``steps`` of them.

    Equal to filling a dense grid and dropping what stays empty, without ever building the grid:
    an empty bin is only reachable from the bin before it. A bin that lacks a value takes the newest one of the
    ``steps`` bins before it, and no value is carried further than ``steps`` bins from its report. ``min_days`` applies the whole-day
    history rule in the same shuffle.
    """
    order = W.partitionBy(key).orderBy("timestamp")
    step = interval(freq)
    rows = bins.withColumn("_next", F.lead("timestamp").over(order))
    if min_days is not None:
        whole = W.partitionBy(key)
        days = whole_days_between(F.min("first_seen").over(whole), F.max("last_seen").over(whole))
        rows = rows.withColumn("_days", days).where(F.col("_days") >= min_days)
    reach = F.col("timestamp") + F.expr(f"{steps} * INTERVAL '{freq}'")
    last = F.when(F.col("_next").isNull(), F.col("timestamp")).otherwise(F.least(reach, F.col("_next") - step))
    kept = [c for c in bins.columns if c not in ("timestamp", "first_seen", "last_seen")]
    fixed = [c for c in kept if c == key or c in schemas.STATIC_COLS]
    values = [c for c in kept if c not in fixed]
    near = order.rowsBetween(-steps, 0)
    seen = {
        f"_seen_{c}": F.last(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), "timestamp")), True).over(near)
        for c in values
    }
    spread = rows.withColumns(seen).select(
        *fixed, *seen, F.explode(F.sequence("timestamp", last, step)).alias("timestamp")
    )
    current = lambda c: F.when(
        F.col("timestamp") <= F.col(f"_seen_{c}.timestamp") + F.expr(f"{steps} * INTERVAL '{freq}'"), F.col(f"_seen_{c}.v")
    )
    return spread.select(*[F.col(c) if c in fixed else current(c).alias(c) for c in kept], "timestamp")


def resample(
    df: DataFrame, freq: str = GRID, steps: int = FILL_STEPS, min_days: int | None = None, **binning
) -> DataFrame:
    """One row per (station, bin) with gaps of up to ``steps`` bins filled."""
    bins = bin_status(df, freq, **binning)
    counts = binning.get("means", schemas.COUNT_COLS)
    return fill_forward(bins, freq, steps, binning.get("key", "station_id"), min_days).na.drop(subset=counts)


def dense_grid(bins: DataFrame, freq: str = GRID, key: str = "station_id") -> DataFrame:
    """Every bin between the first and the last one of each station, empty ones with nulls.

    A bin is followed by the empty ones up to the next bin of its station, so bins alone are shuffled; the grid comes to be behind
    that, dealt by station as windows over stations need it. ``bins`` lie on the grid, as those of ``bin_status`` do.
    """
    spark, step = bins.sparkSession, interval(freq)
    # A given number of partitions: merged by the size of their bins they could hold grids of any size.
    dealt = bins.where(F.col("timestamp").isNotNull()).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    following = F.lead("timestamp").over(W.partitionBy(key).orderBy("timestamp"))
    rows = dealt.withColumn("_next", F.coalesce(following, F.col("timestamp") + step))
    places = F.sequence("timestamp", F.greatest(F.col("timestamp"), F.col("_next") - step), step)
    values = [c for c in bins.columns if c not in (key, "timestamp")]
    spread = rows.select(key, *values, F.posexplode(places).alias("_place", "timestamp"))
    own = (F.col("_place") == 0) & F.col(key).isNotNull()
    return spread.select(key, "timestamp", *[F.when(own, F.col(c)).alias(c) for c in values])


def ffill_limited(grid: DataFrame, columns: list[str], steps: int = FILL_STEPS, key: str = "station_id") -> DataFrame:
    """Per column forward fill over at most ``steps`` consecutive nulls of a dense grid."""
    order = W.partitionBy(key).orderBy("timestamp")
    return grid.withColumns(
        {c: F.coalesce(F.col(c), *[F.lag(c, n).over(order) for n in range(1, steps + 1)]) for c in columns}
    )


def attach_statics(resampled: DataFrame, information: DataFrame, how: str = "left") -> DataFrame:
    """Per-station constants, joined after the reduction to bins instead of onto raw rows."""
    statics = information.select("station_id", *schemas.STATIC_COLS)
    return resampled.join(statics, "station_id", how)
