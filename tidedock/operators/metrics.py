"""Regression error metrics: global, per group, per model, and comparisons between models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock.functions.stats import improvement_pct, regression_aggregates


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: list[str] | None = None, with_count: bool = False
) -> DataFrame:
    """MAE, RMSE and R², per group when ``by`` is given."""
    aggs = [e.alias(n) for n, e in regression_aggregates(F.col(actual), F.col(predicted)).items()]
    if with_count:
        aggs.append(F.count("*").alias("n"))
    return df.groupBy(*(by or [])).agg(*aggs)


def metrics_by_station(df: DataFrame, actual: str = "y", predicted: str = "prediction") -> DataFrame:
    return regression_metrics(df, actual, predicted, ["station_id"])


def metrics_by_hour(df: DataFrame, actual: str = "y", predicted: str = "prediction") -> DataFrame:
    return regression_metrics(df, actual, predicted, ["hour"])


def model_improvement(metrics: DataFrame, baseline: str = "naive") -> DataFrame:
    """Relative MAE gain of every model over the baseline model, in percent.

    ``metrics`` has one row per trained model, so the window over all of them is small; its input is computed once.
    """
    base = F.max(F.when(F.col("model") == baseline, F.col("mae"))).over(W.partitionBy())
    return metrics.withColumn("improvement_pct", improvement_pct(F.col("mae"), base))


def extreme_stations(per_station: DataFrame, n: int = 10, hardest: bool = True) -> DataFrame:
    """The ``n`` stations with the largest (or smallest) MAE, ids breaking ties."""
    order = F.col("mae").desc() if hardest else F.col("mae").asc()
    return per_station.orderBy(order, "station_id").limit(n)


def residuals(df: DataFrame, actual: str = "y", predicted: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def display_metrics(metrics: DataFrame) -> DataFrame:
    """Presentation names."""
    return metrics.withColumnsRenamed({"model": "Model", "mae": "MAE", "rmse": "RMSE", "r2": "R2"})
