"""Code-to-label expressions, colour bands and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of the availability, drift and severity bands.
AVAILABILITY_BANDS = [(10, "red"), (30, "orange"), (70, "blue")]
PSI_MODERATE, PSI_SIGNIFICANT = 0.1, 0.2
SCORE_BANDS = [(20, "low"), (50, "medium")]
MAE_ALERT_FACTOR = 1.2


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend == 0, "Weekday").when(is_weekend == 1, "Weekend")


def outlier_status(label: Column) -> Column:
    return F.when(label == -1, "Outlier").when(label == 1, "Normal")


def anomaly_status(is_anomalous: Column) -> Column:
    return F.when(is_anomalous, "Anomalous").otherwise("Normal")


def drift_status(drifted: Column) -> Column:
    return F.when(drifted, "Drifted").when(~drifted, "Stable")


def psi_severity(psi: Column) -> Column:
    return (
        F.when(psi > PSI_SIGNIFICANT, "significant").when(psi > PSI_MODERATE, "moderate").otherwise("stable")
    )


def score_severity(share: Column) -> Column:
    pct = share * 100
    return F.when(pct < SCORE_BANDS[0][0], "low").when(pct < SCORE_BANDS[1][0], "medium").otherwise("high")


def availability_pct(bikes: Column, capacity: Column) -> Column:
    """Share of capacity in use; a zero capacity counts as one dock."""
    return bikes / F.when(capacity == 0, 1).otherwise(capacity) * 100


def availability_band(pct: Column, is_renting: Column) -> Column:
    band = F.when(~is_renting, "black")
    for limit, colour in AVAILABILITY_BANDS:
        band = band.when(pct <= limit, colour)
    return band.otherwise("green")


def fill_pct(avg_bikes: Column, capacity: Column) -> Column:
    return F.bround(F.try_divide(avg_bikes, capacity) * 100, 1)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def short_name(name: Column, length: int = 25) -> Column:
    return F.substring(name, 1, length)


def last_change_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit("Never (in window)"))


def clamp_prediction(value: Column) -> Column:
    """Two decimals, half to even, never negative."""
    return F.greatest(F.lit(0.0), F.bround(value, 2))


def null_if_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))
