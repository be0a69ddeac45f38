"""The monitoring run: baseline, look-back window, drift report, one status per requested model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedock.operators.drift import MIN_PREDICTIONS, drift_report


def recent_pairs(predictions: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Complete pairs of the last ``days`` days before ``as_of``, all models."""
    since = as_of - F.expr(f"INTERVAL {int(days)} DAYS")
    return predictions.where(F.col("actual_value").isNotNull() & (F.col("target_time") >= since))


def monitoring_status(
    predictions: DataFrame, baselines: DataFrame, models: DataFrame, as_of: Column, days: int = 7
) -> DataFrame:
    """``unknown_model``, ``no_data``, ``insufficient``, ``alert`` or ``ok`` for every name in ``models``."""
    pairs = recent_pairs(predictions, as_of, days)
    counts = pairs.groupBy("model_name").agg(F.count("*").alias("n"))
    known = baselines.select(F.col("model").alias("model_name"), F.lit(True).alias("_known"))
    report = drift_report(pairs, baselines).select("model_name", "current_mae", "mae_alert")
    rows = (
        models.select("model_name").distinct()
        .join(known, "model_name", "left")
        .join(counts, "model_name", "left")
        .join(report, "model_name", "left")
    )
    n = F.coalesce("n", F.lit(0))
    status = (
        F.when(F.col("_known").isNull(), "unknown_model")
        .when(n == 0, "no_data")
        .when(n < MIN_PREDICTIONS, "insufficient")
        .when(F.col("mae_alert"), "alert")
        .otherwise("ok")
    )
    return rows.select("model_name", n.alias("n_predictions"), "current_mae", status.alias("status"))
