"""Table scans. Reads are lazy, explicitly typed and shaped so that filters reach the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidedock import schemas
from tidedock.functions.labels import null_if_nan
from tidedock.sources import versions
from tidedock.sources.feeds import parse_station_information, read_documents

ENRICHED_SCAN = ["station_id", "last_reported", *schemas.COUNT_COLS, *schemas.FLAG_COLS, *schemas.STATIC_COLS]


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with_day(schemas.STATUS)).parquet(path)


#: Partitions of the prediction table: model and UTC day of the target time.
PREDICTION_PARTS = ["model_name", "target_on"]


def read_predictions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return versions.read(spark, path, _with_day(schemas.PREDICTIONS, "target_on"), PREDICTION_PARTS, version)


def _with_day(schema: T.StructType, name: str = "reported_on") -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.DateType(), True)])


def read_snapshot(spark: SparkSession, path: str, schema=schemas.INFORMATION, version: int | None = None) -> DataFrame:
    """A version of a snapshot, by default the newest (see ``writers.write_snapshot``)."""
    return versions.read(spark, path, schema, [], version)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN read from files written by dataframe libraries means a missing value."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: null_if_nan(F.col(c)) for c in doubles}) if doubles else df


def load_raw_status(enriched: DataFrame, min_days: int = 7) -> DataFrame:
    """The 11 columns of the enriched history that the dataset needs, long-lived stations only."""
    from tidedock.operators.regularise import min_history

    return min_history(nan_to_null(enriched.select(*ENRICHED_SCAN)), min_days)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits with their ``split`` column; a filter on it prunes directories."""
    return nan_to_null(spark.read.parquet(path))


def union_splits(train: DataFrame, val: DataFrame, test: DataFrame) -> DataFrame:
    parts = [df.withColumn("split", F.lit(name)) for name, df in (("train", train), ("val", val), ("test", test))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def station_names(information: DataFrame) -> DataFrame:
    """``station_id -> name``, the id itself where the name is missing."""
    key = F.col("station_id").cast("string")
    return information.select(key.alias("station_id"), F.coalesce("name", key).alias("name"))


def read_station_names(spark: SparkSession, path: str) -> DataFrame:
    return station_names(parse_station_information(read_documents(spark, path)))


def list_stations(information: DataFrame) -> DataFrame:
    """Listing with defaults for missing attributes. Count it with :func:`station_count`."""
    key = F.col("station_id").cast("string")
    return information.select(
        key.alias("station_id"),
        F.coalesce("name", key).alias("name"),
        F.coalesce("lat", F.lit(0.0)).alias("lat"),
        F.coalesce("lon", F.lit(0.0)).alias("lon"),
        F.coalesce("capacity", F.lit(0)).alias("capacity"),
    )


def station_count(information: DataFrame) -> DataFrame:
    return information.agg(F.count("*").alias("count"))


def load_predictions(predictions: DataFrame, model_name: str, since: Column | None = None) -> DataFrame:
    """Complete prediction/actual pairs of one model, optionally from ``since`` on."""
    complete = F.col("actual_value").isNotNull() & ~F.isnan("actual_value")
    rows = predictions.where((F.col("model_name") == model_name) & complete)
    if since is not None:
        rows = rows.where(F.col("target_time") >= since)
    return rows.select("station_id", "target_time", "predicted_value", "actual_value")


def read_metrics(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Model metrics; an absent table is an error unless ``missing_ok``, then it is empty."""
    return _read_json(spark, path, schemas.METRICS, missing_ok)


def read_feature_importance(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, schemas.IMPORTANCE, missing_ok=True)


def read_profiles(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """Stored daily profiles (``schemas.VALUE_COUNTS`` or ``VALUE_SKETCHES``); a filter on ``day`` prunes partitions."""
    return versions.read(spark, path, schema, ["day"], version)


def _read_json(spark: SparkSession, path: str, schema, missing_ok: bool) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
