"""Both anomaly detectors over one set of station profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidedock.operators import anomaly
from tidedock.operators.forest import isolation_forest
from tidedock.staging import stage


def profiles(df: DataFrame) -> DataFrame:
    """Station profiles, written once because several results read them."""
    return stage(anomaly.station_profiles(df), "profiles")


def analyze_anomalies(
    df: DataFrame, stuck_hours: float = anomaly.STUCK_HOURS, contamination: float = anomaly.CONTAMINATION, seed: int = 42
) -> DataFrame:
    """Stations that are stuck or outlying, with both measures."""
    anomaly.check_thresholds(stuck_hours, contamination)
    found = profiles(df)
    scored = isolation_forest(anomaly._activity(found), contamination, seed)
    return anomaly.combine(anomaly._stuck(found, stuck_hours), scored)
