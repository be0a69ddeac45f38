"""Curated layer: facts with their dimension, latest row per station, name lookups.

The dimension side carries no broadcast hint. Spark broadcasts it when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive execution splits a
hot station on the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedock.functions import labels

FACT_COLS = [
    "station_id", "last_reported", "ingestion_timestamp",
    "num_bikes_available", "num_docks_available", "num_bikes_disabled", "num_docks_disabled",
    "is_renting", "is_returning", "status",
]


def station_status_enriched(status: DataFrame, information: DataFrame) -> DataFrame:
    """Every fact row with current dimension attributes; unknown stations keep nulls."""
    dimension = information.withColumnRenamed("updated_at", "station_info_updated_at")
    return status.select(*FACT_COLS).join(dimension, "station_id", "left")


def station_status_latest(status: DataFrame, information: DataFrame) -> DataFrame:
    """One row per station: newest report, ties by ingestion time. Reduced before the join."""
    return station_status_enriched(latest_rows(status), information)


def latest_rows(status: DataFrame) -> DataFrame:
    """Newest report per station, ties by ingestion time, then by the other columns."""
    order = ["last_reported", "ingestion_timestamp", *[c for c in FACT_COLS[3:]]]
    return newest_rows(status.select(*FACT_COLS), "station_id", "last_reported", order)


def newest_rows(df: DataFrame, key: str, time_col: str, order_by: list[str]) -> DataFrame:
    """Last row per key in ``order_by``, which starts with ``time_col``.

    The newest time of a key is a hash aggregation over two narrow columns; rows of that time are found by a join and
    only those few are ordered. Nothing sorts the raw rows.
    """
    newest = df.groupBy(F.col(key).alias("_k")).agg(F.max(time_col).alias("_t"))
    tied = df.join(newest, (F.col(key) == F.col("_k")) & F.col(time_col).eqNullSafe(F.col("_t"))).drop("_k", "_t")
    payload = [c for c in df.columns if c != key]
    picked = tied.groupBy(key).agg(F.max_by(F.struct(*payload), F.struct(*order_by)).alias("r"))
    return picked.select(key, "r.*").select(*df.columns)


def with_station_name(df: DataFrame, names: DataFrame) -> DataFrame:
    looked_up = names.select("station_id", F.col("name").alias("_name"))
    return (
        df.join(looked_up, "station_id", "left")
        .withColumn("station_name", F.coalesce("_name", "station_id"))
        .drop("_name")
    )


def station_geo_snapshot(latest: DataFrame, information: DataFrame) -> DataFrame:
    """Known stations of a snapshot with place, load and availability band."""
    place = information.select("station_id", "lat", "lon", "name", "capacity")
    rows = place.join(latest.select("station_id", "is_renting", "num_bikes_available"), "station_id", "inner")
    pct = labels.availability_pct(F.col("num_bikes_available"), F.col("capacity"))
    return rows.withColumn("availability_pct", pct).withColumn(
        "band", labels.availability_band(F.col("availability_pct"), F.col("is_renting"))
    )


def orphan_station_ids(status: DataFrame, information: DataFrame) -> DataFrame:
    return status.select("station_id").distinct().join(information.select("station_id"), "station_id", "left_anti")


def filter_by_stations(df: DataFrame, station_ids: list[str] | DataFrame | None) -> DataFrame:
    """Rows of the listed stations; an empty list keeps everything. Long lists go in as a DataFrame."""
    if station_ids is None or (isinstance(station_ids, list) and not station_ids):
        return df
    if isinstance(station_ids, DataFrame):
        return df.join(station_ids.select("station_id").distinct(), "station_id", "left_semi")
    return df.where(F.col("station_id").isin(station_ids))
