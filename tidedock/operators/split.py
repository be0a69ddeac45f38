"""Time-based train/validation/test split on distinct timestamps, and its leakage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock import schemas

TRAIN_FRAC, VAL_FRAC = 0.80, 0.10  # fixed values: validation is the end of the train share


def split_cuts(
    df: DataFrame, train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC, time_col: str = "timestamp"
) -> DataFrame:
    """One row with the first validation and the first test timestamp.

    Positions in the sorted distinct timestamps come from counts per day plus the position inside
    the day, so the only unpartitioned window sees one row per day.
    """
    stamps = df.select(F.col(time_col).alias("t")).distinct().withColumn("day", F.to_date("t"))
    days = stamps.groupBy("day").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("n").over(W.partitionBy())
    days = days.select("day", "n", F.coalesce(before, F.lit(0)).alias("offset"), total.alias("total"))
    test_at = (F.col("total") * F.lit(train_frac)).cast("long")
    val_at = (test_at * F.lit(1 - val_frac)).cast("long")
    days = days.withColumns({"test_at": test_at, "val_at": val_at})
    inside = lambda c: (F.col(c) >= F.col("offset")) & (F.col(c) < F.col("offset") + F.col("n"))
    wanted = days.where(inside("test_at") | inside("val_at") | (F.col("offset") == 0))
    numbered = stamps.join(wanted, "day").withColumn(
        "idx", F.col("offset") + F.row_number().over(W.partitionBy("day").orderBy("t")) - 1
    )
    picked = numbered.agg(
        F.max(F.when(F.col("idx") == F.col("val_at"), F.col("t"))).alias("val_from"),
        F.max(F.when(F.col("idx") == F.col("test_at"), F.col("t"))).alias("test_from"),
        F.max("test_at").alias("test_at"),
        F.max("total").alias("n_timestamps"),
    )
    valid = (F.col("test_at") >= 1) & (F.col("test_at") < F.col("n_timestamps"))
    problem = F.raise_error(F.lit("the split leaves train or test empty"))
    return picked.select(
        "val_from", F.when(valid, F.col("test_from")).otherwise(problem).alias("test_from"), "n_timestamps"
    )


def time_based_split(
    df: DataFrame, train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC, time_col: str = "timestamp"
) -> DataFrame:
    """The input with a ``split`` column.

    The two cuts are read first and enter the plan as literals. The result is the union of three time ranges
    with a constant label each: a later filter on ``split`` leaves only the wanted branches, whose ranges are pushed
    to the files. Pass a written table: it is read for the cuts and once per branch. Rows without a timestamp are
    train rows.
    """
    val_from, test_from = (_literal(c, dict(df.dtypes)[time_col]) for c in read_cuts(df, train_frac, val_frac, time_col))
    t = F.col(time_col)
    ranges = {
        "train": (t < val_from) | t.isNull(),
        "val": (t >= val_from) & (t < test_from),
        "test": t >= test_from,
    }
    parts = [df.where(condition).withColumn("split", F.lit(name)) for name, condition in ranges.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_cuts(
    df: DataFrame, train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC, time_col: str = "timestamp"
) -> tuple[str | int, str | int]:
    """The two cuts: local text without a time zone, else microseconds since the epoch."""
    zoned = dict(df.dtypes)[time_col] == "timestamp"
    plain = (lambda c: F.unix_micros(c)) if zoned else (lambda c: F.col(c).cast("string"))
    return tuple(split_cuts(df, train_frac, val_frac, time_col).select(plain("val_from"), plain("test_from")).first())


def _literal(cut: str | int, kind: str) -> Column:
    return F.timestamp_micros(F.lit(cut)) if kind == "timestamp" else F.lit(cut).cast(kind)


def split_summary(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Rows, time range and number of stations per split."""
    per_station = df.groupBy("split", "station_id").agg(
        F.count("*").alias("n"), F.min(time_col).alias("lo"), F.max(time_col).alias("hi")
    )
    return per_station.groupBy("split").agg(
        F.sum("n").alias("n_rows"),
        F.min("lo").alias("first_timestamp"),
        F.max("hi").alias("last_timestamp"),
        F.count("station_id").alias("n_stations"),
    )


def rows_per_interval(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df.groupBy("split", time_col).agg(F.count("*").alias("n_rows"))


def leakage_report(features: DataFrame, series: DataFrame) -> DataFrame:
    """Mismatches against lags and target recomputed from ``series``, nulls and split overlaps.

    Every station is checked. ``features`` carries a ``split`` column.
    """
    order = W.partitionBy("station_id").orderBy("timestamp")
    value = F.col("num_bikes_available")
    expected = series.select(
        "station_id",
        "timestamp",
        *[F.lag(value, n).over(order).alias(f"_lag_{n}") for n in (1, 2, 3, 4)],
        F.lead(value, 1).over(order).alias("_target"),
    )
    joined = features.join(expected, ["station_id", "timestamp"], "left")
    checked = [*schemas.FEATURE_COLS, schemas.TARGET_COL]
    side = lambda s, agg: agg(F.when(F.col("split") == s, F.col("timestamp")))
    totals = joined.agg(
        *[F.count_if(~F.col(f"bikes_lag_{n}").eqNullSafe(F.col(f"_lag_{n}"))).alias(f"bikes_lag_{n}") for n in (1, 2, 3, 4)],
        F.count_if(~F.col(schemas.TARGET_COL).eqNullSafe(F.col("_target"))).alias("target"),
        F.sum(sum(F.col(c).isNull().cast("int") for c in checked)).alias("nulls"),
        (side("train", F.max) >= side("val", F.min)).cast("long").alias("train_val_overlap"),
        (side("val", F.max) >= side("test", F.min)).cast("long").alias("val_test_overlap"),
    )
    names = ["bikes_lag_1", "bikes_lag_2", "bikes_lag_3", "bikes_lag_4", "target", "nulls",
             "train_val_overlap", "val_test_overlap"]
    rows = totals.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in names])
        ).alias("r")
    ).select("r.*")
    return rows.withColumn("passed", F.col("violations") == 0)
