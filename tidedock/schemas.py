"""Table contracts: explicit schemas, column orders and schema assertions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names and order are the public contract of each table.
STATUS_GRAIN = ["station_id", "last_reported"]
PREDICTION_GRAIN = ["station_id", "target_time", "model_name"]
ANOMALY_GRAIN = ["station_id", "detected_at"]

COUNT_COLS = ["num_bikes_available", "num_docks_available", "num_bikes_disabled", "num_docks_disabled"]
FLAG_COLS = ["is_renting", "is_returning"]
STATIC_COLS = ["capacity", "lat", "lon"]

REQUIRED_STATUS = [
    "station_id", "num_bikes_available", "num_docks_available", "last_reported",
    "is_renting", "is_returning", "status",
]
REQUIRED_INFORMATION = ["station_id", "name", "lat", "lon", "capacity"]

FEATURE_COLS = [
    "num_bikes_available", "num_docks_available",
    "bikes_lag_1", "bikes_lag_2", "bikes_lag_3", "bikes_lag_4",
    "bikes_rolling_mean_1h", "bikes_rolling_std_1h",
    "hour", "weekday", "is_weekend", "month",
    "capacity", "lat", "lon",
]
TARGET_COL = "y"

_TS = T.TimestampType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STATUS = _struct(
    ("station_id", T.StringType()),
    ("num_bikes_available", T.IntegerType()),
    ("num_docks_available", T.IntegerType()),
    ("num_bikes_disabled", T.IntegerType()),
    ("num_docks_disabled", T.IntegerType()),
    ("last_reported", _TS),
    ("is_renting", T.BooleanType()),
    ("is_returning", T.BooleanType()),
    ("status", T.StringType()),
    ("ingestion_timestamp", _TS),
)

INFORMATION = _struct(
    ("station_id", T.StringType()),
    ("name", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("capacity", T.IntegerType()),
    ("address", T.StringType()),
    ("groups", T.ArrayType(T.StringType())),
    ("updated_at", _TS),
)

PREDICTIONS = _struct(
    ("station_id", T.StringType()),
    ("prediction_time", _TS),
    ("target_time", _TS),
    ("model_name", T.StringType()),
    ("predicted_value", T.DoubleType()),
    ("actual_value", T.DoubleType()),
    ("created_at", _TS),
)

#: Summaries of the reports of a station on a UTC day (``anomaly.slice_summaries``).
SLICES = _struct(
    ("station_id", T.StringType()),
    ("slice", _TS),
    ("n", T.LongType()),
    ("total", T.LongType()),
    ("var", T.DoubleType()),
    ("zeros", T.LongType()),
    ("changes", T.LongType()),
    ("last_change", _TS),
    ("first_ts", _TS),
    ("last_ts", _TS),
    ("first_value", T.IntegerType()),
    ("last_value", T.IntegerType()),
    ("is_renting", T.BooleanType()),
    ("slice_on", T.DateType()),
)

ANOMALIES = _struct(
    ("station_id", T.StringType()),
    ("detected_at", _TS),
    ("is_stuck", T.BooleanType()),
    ("is_statistical_outlier", T.BooleanType()),
    ("stuck_duration_hours", T.DoubleType()),
    ("isolation_score", T.DoubleType()),
    ("resolved_at", _TS),
    ("notes", T.StringType()),
)

METRICS = _struct(
    ("model", T.StringType()), ("mae", T.DoubleType()), ("rmse", T.DoubleType()), ("r2", T.DoubleType())
)
IMPORTANCE = _struct(("feature", T.StringType()), ("importance", T.DoubleType()))


def _feed(member: str, element: T.StructType) -> T.StructType:
    return _struct(
        ("version", T.StringType()),
        ("last_updated", T.LongType()),
        ("ttl", T.IntegerType()),
        ("data", _struct((member, T.ArrayType(element)))),
    )


def _text_fields(*names: str) -> T.StructType:
    # Leaves are read as text so that one malformed value rejects one record, not the file.
    return _struct(*[(n, T.StringType()) for n in names])


STATUS_FEED = _feed("stations", _text_fields(*REQUIRED_STATUS, "num_bikes_disabled", "num_docks_disabled"))
INFORMATION_FEED = _feed(
    "stations",
    T.StructType([
        *_text_fields(*REQUIRED_INFORMATION, "address").fields,
        T.StructField("groups", T.ArrayType(T.StringType()), True),
    ]),
)
VEHICLE_TYPES_FEED = _feed(
    "vehicle_types", _text_fields("vehicle_type_id", "name", "form_factor", "propulsion_type")
)
DISCOVERY_FEED = _struct(
    ("version", T.StringType()),
    ("last_updated", T.LongType()),
    ("ttl", T.IntegerType()),
    (
        "data",
        T.MapType(
            T.StringType(),
            _struct(("feeds", T.ArrayType(_struct(("name", T.StringType()), ("url", T.StringType()))))),
        ),
    ),
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail while the plan is being built, before any job starts, when a column is absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df

#: Stored daily profiles, see ``operators/profiles.py``; partitioned by ``day``.
VALUE_COUNTS = _struct(
    ("day", T.DateType()), ("feature", T.StringType()), ("value", T.DoubleType()), ("n", T.LongType())
)
VALUE_SKETCHES = _struct(
    ("day", T.DateType()),
    ("feature", T.StringType()),
    ("n", T.LongType()),
    ("total", T.DoubleType()),
    ("lo", T.DoubleType()),
    ("hi", T.DoubleType()),
    ("quantiles", T.BinaryType()),
    ("distinct", T.BinaryType()),
)
