"""The supplied tables in the shape of the station tables.

``events`` become status reports (one station per user), ``supplier`` with ``nation`` the station
dimension. Everything else is derived from these with the library's own operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedock.operators.merge import first_per_key
from tidedock.plans import dataset
from tidedock.staging import stage

AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def status(spark: SparkSession, sf: str, with_seq: bool = False) -> DataFrame:
    columns = [
        "CAST(user_id AS STRING) AS station_id",
        "ts AS last_reported",
        "CAST(FLOOR(value) AS INT) % 31 AS num_bikes_available",
        "30 - CAST(FLOOR(value) AS INT) % 31 AS num_docks_available",
        "CAST(event_id % 3 AS INT) AS num_bikes_disabled",
        "CAST(event_id % 2 AS INT) AS num_docks_disabled",
        "event_type <> 'error' AS is_renting",
        "event_type <> 'signup' AS is_returning",
        "event_type AS status",
        "CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 MINUTE ELSE ts + INTERVAL 1 MINUTE END"
        " AS ingestion_timestamp",
    ]
    if with_seq:
        columns.append("event_id AS seq")
    return table(spark, sf, "events").selectExpr(*columns)


def daily_status(spark: SparkSession, sf: str) -> DataFrame:
    """Reports truncated to the day, so that keys repeat; ``seq`` keeps their order."""
    day = F.to_date("last_reported").cast("timestamp_ntz")
    return status(spark, sf, with_seq=True).withColumn("last_reported", day)


def information(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "CAST(s_suppkey AS STRING) AS station_id",
        "s_name AS name",
        "CAST(-23.5 - 0.001 * s_nationkey AS DOUBLE) AS lat",
        "CAST(-46.6 - 0.001 * (s_suppkey % 50) AS DOUBLE) AS lon",
        "CAST(30 + s_suppkey % 10 AS INT) AS capacity",
        "CAST(NULL AS STRING) AS address",
        "array(n_name) AS groups",
        f"CAST('{AS_OF}' AS TIMESTAMP_NTZ) AS updated_at",
    )


def information_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension records reported along with every event; later ones replace earlier ones."""
    return table(spark, sf, "events").selectExpr(
        "CAST(user_id AS STRING) AS station_id",
        "concat('Dock ', event_id) AS name",
        "CAST(-23.5 - 0.001 * (event_id % 25) AS DOUBLE) AS lat",
        "CAST(-46.6 - 0.001 * (event_id % 50) AS DOUBLE) AS lon",
        "CAST(20 + event_id % 20 AS INT) AS capacity",
        "event_type AS address",
        "array(event_type) AS groups",
        "event_id AS seq",
    )


def status_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One feed document per event. Some lack optional fields, a required field or the envelope."""
    return table(spark, sf, "events").selectExpr(
        "event_id",
        """to_json(named_struct('last_updated', unix_seconds(CAST(ts AS TIMESTAMP)), 'ttl', 30, 'data',
             CASE WHEN event_id % 101 = 0 THEN NULL ELSE named_struct('stations', array(named_struct(
               'station_id', CAST(user_id AS STRING),
               'num_bikes_available', CAST(FLOOR(value) AS INT) % 31,
               'num_docks_available', 30 - CAST(FLOOR(value) AS INT) % 31,
               'num_bikes_disabled', CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 3 END,
               'num_docks_disabled', CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 2 END,
               'last_reported', unix_seconds(CAST(ts AS TIMESTAMP)),
               'is_renting', event_type <> 'error',
               'is_returning', event_type <> 'signup',
               'status', CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END))) END)) AS document""",
    )


def information_documents(spark: SparkSession, sf: str) -> DataFrame:
    return information(spark, sf).selectExpr(
        """to_json(named_struct('ttl', 30, 'data', named_struct('stations', array(named_struct(
             'station_id', station_id, 'name', name, 'lat', lat, 'lon', lon,
             'capacity', CASE WHEN CAST(station_id AS INT) % 13 = 0 THEN NULL ELSE capacity END,
             'groups', CASE WHEN CAST(station_id AS INT) % 5 = 0 THEN NULL ELSE groups END))))) AS document"""
    )


def series(spark: SparkSession, sf: str, freq: str = "15 minutes") -> DataFrame:
    """Filled grid rows with constants (null for unknown stations)."""
    return dataset.regular_series(status(spark, sf), information(spark, sf), freq)


def features(spark: SparkSession, sf: str, freq: str = "15 minutes") -> DataFrame:
    return dataset.feature_table(status(spark, sf), information(spark, sf), freq)


def staged_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features as a written table, for operators that read their input more than once."""
    return stage(features(spark, sf), "features")


def splits(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.split_table(status(spark, sf), information(spark, sf))


def test_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits(spark, sf).where(F.col("split") == "test")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two models over every feature row: the previous value and the one-hour mean."""
    return predictions_of(features(spark, sf))


def predictions_of(rows: DataFrame) -> DataFrame:
    rows = rows.select(
        "station_id",
        "timestamp",
        F.explode(
            F.array(
                F.struct(F.lit("naive").alias("model_name"), F.col("bikes_lag_1").alias("predicted_value")),
                F.struct(F.lit("mean").alias("model_name"), F.col("bikes_rolling_mean_1h").alias("predicted_value")),
            )
        ).alias("p"),
        F.col("y").alias("actual_value"),
    )
    return rows.select(
        "station_id",
        as_of().alias("prediction_time"),
        (F.col("timestamp") + F.expr("INTERVAL 15 MINUTES")).alias("target_time"),
        "p.model_name",
        "p.predicted_value",
        "actual_value",
    )


def drift_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Splits with the rolling features at nine decimals.

    Equal windows can differ in the last digit of their deviation, which would count as different values.
    """
    return _nine_decimals(splits(spark, sf))


def drift_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows with the rolling features at nine decimals, as in `drift_splits`."""
    return _nine_decimals(features(spark, sf))


def _nine_decimals(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 9) for c in ["bikes_rolling_mean_1h", "bikes_rolling_std_1h"]})


def baselines_of(rows: DataFrame) -> DataFrame:
    """Baseline MAE per model from the train split."""
    from tidedock.operators.metrics import regression_metrics

    train = rows.where(F.col("split") == "train")
    long = train.select("y", F.col("bikes_lag_1").alias("naive"), F.col("bikes_rolling_mean_1h").alias("mean"))
    long = long.unpivot(["y"], ["naive", "mean"], "model", "prediction")
    return regression_metrics(long, "y", "prediction", ["model"])


def first_daily_views(spark: SparkSession, sf: str) -> DataFrame:
    """An existing table: the first 'view' report per station and day."""
    views = daily_status(spark, sf).where(F.col("status") == "view")
    return first_per_key(views, ["station_id", "last_reported"], ["seq"])
