"""Stuck stations, activity profiles and their combination with isolation-forest outliers.

Both station aggregates run in two levels. Rows are reduced per (station, time slice), where change
detection needs only the order inside the slice; the slice summaries are then chained per station. A station
that holds a third of the rows is spread over its slices. Reports carry whole seconds and are unique per
station and time, so a day holds at most 86,400 of them; a shorter ``slice_width`` lowers that further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas
from tidedock.functions import labels
from tidedock.functions.timefns import hours_between

# Defaults of both detectors.
STUCK_HOURS = 2.0
CONTAMINATION = 0.05
SLICE = "1 day"
VALUE = "num_bikes_available"


def check_thresholds(stuck_hours: float, contamination: float) -> None:
    """Accepted ranges of the user-facing parameters."""
    if not 0.5 <= stuck_hours <= 24.0:
        raise ValueError("stuck_hours must lie between 0.5 and 24")
    if not 0.01 <= contamination <= 0.50:
        raise ValueError("contamination must lie between 0.01 and 0.5")


def slice_summaries(df: DataFrame, slice_width: str = SLICE) -> DataFrame:
    """One row per (station, slice) with everything both detectors need; one shuffle of the input.

    A report without a value says nothing about the load: it enters neither means, shares, changes nor times.
    """
    schemas.require_columns(df, ["station_id", "timestamp", VALUE])
    optional = [c for c in ("num_docks_available", "capacity", "is_renting") if c in df.columns]
    part = F.window("timestamp", slice_width).getField("start").alias("slice")
    rows = df.where(F.col(VALUE).isNotNull() & ~F.isnan(F.col(VALUE).cast("double")))
    rows = rows.select("station_id", "timestamp", VALUE, *optional, part)
    order = W.partitionBy("station_id", "slice").orderBy("timestamp")
    rows = rows.withColumn("_changed", F.col(VALUE) != F.lag(VALUE).over(order))
    t = F.col("timestamp")
    aggs = [
        F.count("*").alias("n"),
        F.sum(VALUE).alias("total"),
        F.var_pop(VALUE).alias("var"),
        F.count_if(F.col(VALUE) == 0).alias("zeros"),
        F.count_if("_changed").alias("changes"),
        F.max(F.when(F.col("_changed"), t)).alias("last_change"),
        F.min(t).alias("first_ts"),
        F.max(t).alias("last_ts"),
        F.min_by(VALUE, t).alias("first_value"),
        F.max_by(VALUE, t).alias("last_value"),
    ]
    if "num_docks_available" in optional:
        aggs += [F.sum("num_docks_available").alias("docks"), F.count("num_docks_available").alias("n_docks")]
    if "capacity" in optional:
        aggs.append(F.min_by("capacity", t).alias("capacity"))
    if "is_renting" in optional:
        aggs.append(F.max_by("is_renting", t).alias("is_renting"))
    return rows.groupBy("station_id", "slice").agg(*aggs)


def station_profiles(df: DataFrame, slice_width: str = SLICE) -> DataFrame:
    return chained(slice_summaries(df, slice_width))


def chained(slices: DataFrame) -> DataFrame:
    """Slices chained per station: a first value unlike the last one before it is a change too."""
    chain = W.partitionBy("station_id").orderBy("slice")
    station = W.partitionBy("station_id")
    slices = slices.withColumn(
        "_turned", F.coalesce(F.col("first_value") != F.lag("last_value").over(chain), F.lit(False))
    )
    slices = slices.withColumn("_mean", F.sum("total").over(station) / F.sum("n").over(station))
    shift = F.col("total") / F.col("n") - F.col("_mean")
    last_change = F.greatest(F.col("last_change"), F.when(F.col("_turned"), F.col("first_ts")))
    aggs = [
        F.sum("n").alias("n"),
        F.max("_mean").alias("avg_bikes"),
        F.sqrt(F.sum(F.col("n") * (F.col("var") + shift * shift)) / F.sum("n")).alias("std_bikes"),
        (F.sum("zeros") / F.sum("n")).alias("zero_pct"),
        (F.sum("changes") + F.count_if("_turned")).alias("changes"),
        F.max(last_change).alias("last_change"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.max_by("last_value", "slice").alias("last_bikes"),
    ]
    if "docks" in slices.columns:
        aggs.append(F.try_divide(F.sum("docks"), F.sum("n_docks")).alias("avg_docks"))
    if "capacity" in slices.columns:
        aggs.append(F.min_by("capacity", "slice").cast("double").alias("capacity"))
    if "is_renting" in slices.columns:
        aggs.append(F.max_by("is_renting", "slice").alias("is_renting"))
    return slices.groupBy("station_id").agg(*aggs)


def _stuck(profiles: DataFrame, threshold_hours: float) -> DataFrame:
    duration = hours_between(F.coalesce("last_change", "first_ts"), F.col("last_ts"))
    renting = F.col("is_renting") if "is_renting" in profiles.columns else F.lit(None).cast("boolean")
    return profiles.select(
        "station_id",
        "last_change",
        duration.alias("duration_hours"),
        F.col("last_bikes").cast("int").alias("last_bikes"),
        renting.alias("is_renting"),
    ).where(F.col("duration_hours") >= threshold_hours)


def _activity(profiles: DataFrame) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("changes"), F.col("n") - 1), F.lit(0.0))
    optional = [c for c in ("avg_docks", "capacity") if c in profiles.columns]
    return profiles.select(
        "station_id", "avg_bikes", "std_bikes", "zero_pct", rate.alias("change_rate"), *optional
    )


def stuck_stations(df: DataFrame, threshold_hours: float = STUCK_HOURS) -> DataFrame:
    """Stations unchanged for at least the threshold; ``last_change`` is null if never changed."""
    return _stuck(station_profiles(df), threshold_hours)


def stuck_from_slices(slices: DataFrame, threshold_hours: float = STUCK_HOURS) -> DataFrame:
    """``stuck_stations`` from stored slice summaries."""
    return _stuck(chained(slices), threshold_hours)


def station_activity(df: DataFrame) -> DataFrame:
    """Mean, population deviation, zero share, change rate and, if present, docks and capacity."""
    return _activity(station_profiles(df))


def combine(stuck: DataFrame, scored: DataFrame) -> DataFrame:
    """Union of both detectors per station; only flagged stations remain."""
    left = stuck.select("station_id", F.lit(True).alias("_stuck"), "duration_hours")
    right = scored.select("station_id", "anomaly_label", "anomaly_score")
    flagged = left.join(right, "station_id", "full_outer").select(
        "station_id",
        F.coalesce("_stuck", F.lit(False)).alias("is_stuck"),
        F.coalesce(F.col("anomaly_label") == -1, F.lit(False)).alias("is_statistical_outlier"),
        F.coalesce("duration_hours", F.lit(0.0)).alias("stuck_duration_hours"),
        F.coalesce("anomaly_score", F.lit(0.0)).alias("isolation_score"),
    )
    both = F.col("is_stuck") | F.col("is_statistical_outlier")
    return flagged.where(both).withColumn("is_anomalous", F.lit(True))


def rounded_results(results: DataFrame) -> DataFrame:
    return results.withColumns(
        {
            "stuck_duration_hours": F.bround("stuck_duration_hours", 2),
            "isolation_score": F.bround("isolation_score", 4),
        }
    )


def anomaly_records(results: DataFrame, detected_at: Column) -> DataFrame:
    """Flagged stations in the shape of the anomaly table, unresolved."""
    return results.select(
        "station_id",
        detected_at.alias("detected_at"),
        "is_stuck",
        "is_statistical_outlier",
        "stuck_duration_hours",
        "isolation_score",
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("notes"),
    )


def unresolved(anomalies: DataFrame) -> DataFrame:
    return anomalies.where(F.col("resolved_at").isNull())


def anomaly_kpis(df: DataFrame, results: DataFrame) -> DataFrame:
    """Stations in total, flagged, share, and per detector."""
    stations = df.select("station_id").distinct().join(results, "station_id", "left")
    n, flagged = F.count("*"), F.count("is_stuck")
    return stations.agg(
        n.alias("total_stations"),
        flagged.alias("anomalous"),
        (flagged / F.greatest(n, F.lit(1)) * 100).alias("anomalous_pct"),
        F.count_if("is_stuck").alias("stuck"),
        F.count_if("is_statistical_outlier").alias("outliers"),
    )


def anomaly_map(df: DataFrame, results: DataFrame, names: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Place, display name and status of every station."""
    from tidedock.operators.curate import with_station_name

    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(time_col))).alias(c)
    places = df.groupBy("station_id").agg(first("lat"), first("lon"))
    marked = places.join(results.select("station_id", F.lit(True).alias("_hit")), "station_id", "left")
    status = labels.anomaly_status(F.coalesce("_hit", F.lit(False)))
    return with_station_name(marked.withColumn("status", status).drop("_hit"), names)


def stuck_table(stuck: DataFrame, names: DataFrame) -> DataFrame:
    """Display form of the stuck stations."""
    from tidedock.operators.curate import with_station_name

    return with_station_name(stuck, names).select(
        "station_name",
        "station_id",
        F.bround("duration_hours", 1).alias("duration_hours"),
        "last_bikes",
        "is_renting",
        labels.last_change_text(F.col("last_change")).alias("last_change"),
    )


def top_stuck(stuck: DataFrame, n: int = 20) -> DataFrame:
    return stuck.orderBy(F.col("duration_hours").desc(), "station_id").limit(n)


def activity_profile(scored: DataFrame, names: DataFrame) -> DataFrame:
    """Activity features with score, label text and display name per station."""
    from tidedock.operators.curate import with_station_name

    return with_station_name(scored, names).withColumn("status", labels.outlier_status(F.col("anomaly_label")))
