"""Column expressions over timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRID = "15 minutes"


def interval(text: str) -> Column:
    """``"15 minutes"`` as an interval column."""
    return F.expr(f"INTERVAL '{text}'")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def whole_days_between(start: Column, end: Column) -> Column:
    """Complete days only: 6 days 23 hours counts as 6."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(8.64e10)).cast("int")


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def utc_day(df: DataFrame, column: str) -> Column:
    """Day of a time column that does not depend on the session: of the epoch, or of local time without a zone."""
    if dict(df.dtypes)[column] == "timestamp":
        return F.date_from_unix_date(F.floor(F.unix_micros(F.col(column)) / F.lit(86_400_000_000)).cast("int"))
    return F.to_date(column)


def require_utc(spark: SparkSession) -> None:
    """Local fields of zoned times mean UTC here; another session time zone would change them silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


def calendar_fields(ts: Column) -> dict[str, Column]:
    """``weekday`` counts from Monday = 0; ``is_weekend`` is a 0/1 flag."""
    return {
        "hour": F.hour(ts),
        "weekday": F.weekday(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("tinyint"),
        "month": F.month(ts),
    }


def in_date_range(ts: Column, first_day: str, last_day: str) -> Column:
    """Inclusive day range written as a half-open range on the raw column, so it is pushed to the scan."""
    return (ts >= F.lit(first_day).cast("timestamp_ntz")) & (
        ts < F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp_ntz")
    )
